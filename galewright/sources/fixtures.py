"""Adapters that give the star-schema tables the shape of contact rows and of an inference log.

Each adapter is one narrow projection; the contact adapter adds one foreign-key join, whose strategy
and skew handling are left to adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CONTACT_COLUMNS = {
    "contact_key": "o_orderkey",
    "age": "CAST(16 + o_custkey % 77 AS INT)",
    "job": "c_mktsegment",
    "balance": "CAST(FLOOR(c_acctbal / 4) AS INT)",
    "housing": "CASE WHEN o_orderkey % 2 = 0 THEN 'yes' ELSE 'no' END",
    "loan": "CASE WHEN o_orderkey % 5 < 2 THEN 'yes' ELSE 'no' END",
    "duration": "CAST(FLOOR(o_totalprice) AS BIGINT) % 700",
    "campaign": "CAST(1 + o_orderkey % 6 AS INT)",
    "pdays": "CAST(CASE WHEN o_orderkey % 4 = 0 THEN -1 ELSE (o_orderkey * 7) % 400 END AS INT)",
    "previous": "CAST(o_orderkey % 4 AS INT)",
    "y": "CASE WHEN o_orderstatus = 'F' THEN 'yes' ELSE 'no' END",
}

SCORED_COLUMNS = {
    "event_id": "event_id",
    "inference_timestamp": "ts",
    "job": "event_type",
    "balance": "value",
    "model_version": "CAST(1 + user_id % 2 AS INT)",
    "y_flag": "CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END",
    "prediction": "CASE WHEN value >= 40 THEN 1 ELSE 0 END",
}


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its customer's attributes, as a phone-campaign contact."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    return joined.select(*[F.expr(e).alias(n) for n, e in CONTACT_COLUMNS.items()])


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event as a scored, labelled and time-stamped prediction."""
    return as_scored(table(spark, sf_dir, "events"))


def as_scored(events: DataFrame) -> DataFrame:
    return events.select(*[F.expr(e).alias(n) for n, e in SCORED_COLUMNS.items()])
