"""Joins, lookups and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galewright.functions import rules
from galewright.operators import joins
from galewright.operators.scoring import LinearModel, score_by_key
from galewright.plans.features import updated
from galewright.plans.projecting import tier
from galewright.plans.registration import CONTACTS, SCORED, TIER, query, with_sql
from galewright.sources.fixtures import contacts, scored_events, table


@query(
    "join_inner",
    with_sql(SCORED, "late AS (SELECT user_id, max(value) AS later_value, count(*) AS later_rows FROM events WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' GROUP BY user_id)")
    + "SELECT event_id, event_type AS job, value AS balance, later_value, later_rows FROM events JOIN late USING (user_id) WHERE ts < TIMESTAMP '2024-01-08 00:00:00'",
)
def join_inner(spark: SparkSession, sf: str) -> DataFrame:
    """Events of the first week whose user came back, with what the later weeks have of that user."""
    events = table(spark, sf, "events")
    first_week = F.col("ts") < F.expr("timestamp_ntz'2024-01-08 00:00:00'")
    later = events.filter(~first_week).groupBy("user_id").agg(F.max("value").alias("later_value"), F.count(F.lit(1)).alias("later_rows"))
    named = F.col("event_type").alias("job"), F.col("value").alias("balance")
    return events.filter(first_week).join(later, "user_id", "inner").select("event_id", *named, "later_value", "later_rows")


def customer_features(spark: SparkSession, sf: str) -> DataFrame:
    """A feature table keyed by customer; customers in debt have no features yet."""
    solvent = table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
    return solvent.select(
        F.col("c_custkey").alias("customer_id"),
        F.floor(F.col("c_acctbal") / 4).cast("int").alias("balance"),
        F.col("c_mktsegment").alias("job"),
    ).withColumn("balance_tier", rules.band("balance", rules.TIER_BALANCE))


_FEATURES = """features AS (SELECT *, CASE WHEN balance < 0 THEN 'negative' WHEN balance < 300 THEN 'low' WHEN balance < 1000 THEN 'medium' ELSE 'high' END AS balance_tier
  FROM (SELECT c_custkey AS customer_id, CAST(FLOOR(c_acctbal / 4) AS INT) AS balance, c_mktsegment AS job FROM customer WHERE c_acctbal >= 0))"""
_FEATURE_NAMES = ["balance", "job", "balance_tier"]


@query(
    "feature_lookup",
    with_sql(
        _FEATURES, "labels AS (SELECT o_orderkey, o_custkey AS customer_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y_flag FROM orders)"
    )
    + "SELECT o_orderkey, y_flag, balance, job, balance_tier FROM labels LEFT JOIN features USING (customer_id)",
)
def feature_lookup(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("customer_id"), rules.flag(F.col("o_orderstatus") == "F").alias("y_flag")
    )
    return joins.feature_lookup(labels, customer_features(spark, sf), "customer_id", _FEATURE_NAMES, ["customer_id"])


@query(
    "training_set",
    with_sql(
        _FEATURES,
        "labels AS (SELECT o_orderkey, o_custkey AS customer_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y_flag FROM orders)",
        "lines AS (SELECT l_orderkey AS o_orderkey, count(*) AS n_lines, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY l_orderkey)",
    )
    + "SELECT o_orderkey, y_flag, balance, job, n_lines, quantity FROM labels LEFT JOIN features USING (customer_id) LEFT JOIN lines USING (o_orderkey)",
)
def training_set(spark: SparkSession, sf: str) -> DataFrame:
    """Labels with features of two tables, each looked up by its own key."""
    labels = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("customer_id"), rules.flag(F.col("o_orderstatus") == "F").alias("y_flag")
    )
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").cast("bigint").alias("quantity")
    )
    lookups = [
        joins.Lookup(customer_features(spark, sf), "customer_id", ["balance", "job"]),
        joins.Lookup(lines, "o_orderkey", ["n_lines", "quantity"]),
    ]
    return joins.training_set(labels, lookups, ["customer_id"])


# Two of five event types act for one shared account, so that account holds two fifths of the labels.
_SHARED = "CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE user_id END"


@query(
    "feature_lookup_hot",
    with_sql(_FEATURES, f"labels AS (SELECT event_id, {_SHARED} AS customer_id, value FROM events)")
    + "SELECT customer_id, event_id, value, balance, job, balance_tier FROM labels LEFT JOIN features USING (customer_id)",
)
def feature_lookup_hot(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "events").select("event_id", F.expr(_SHARED).alias("customer_id"), "value")
    return joins.feature_lookup(labels, customer_features(spark, sf), "customer_id", _FEATURE_NAMES, hot_share=1 / 16)


def merge_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A target table and an incoming batch: corrected rows of one segment, new rows for another."""
    target = tier(spark, sf).withColumn("merge_action_note", F.lit("original record"))
    corrected = updated(target.filter(F.col("job") == "BUILDING")).withColumn("merge_action_note", F.lit("updated existing record"))
    new = target.filter(F.col("job") == "MACHINERY").withColumns(
        {"contact_key": -F.col("contact_key") - 1, "merge_action_note": F.lit("new inserted record")}
    )
    return target, corrected.unionByName(new)


MERGE_SIDES = """target AS (SELECT *, 'original record' AS merge_action_note FROM tier),
incoming AS (
  SELECT * REPLACE (balance + 2000 AS balance, duration + 60 AS duration, campaign + 1 AS campaign, 'updated existing record' AS merge_action_note)
    FROM target WHERE job = 'BUILDING'
  UNION ALL SELECT * REPLACE (-contact_key - 1 AS contact_key, 'new inserted record' AS merge_action_note) FROM target WHERE job = 'MACHINERY')"""
MERGED_ROWS = "SELECT * FROM target WHERE contact_key NOT IN (SELECT contact_key FROM incoming) UNION ALL SELECT * FROM incoming"


@query("merge_upsert", with_sql(CONTACTS, TIER, MERGE_SIDES) + MERGED_ROWS)
def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return joins.merge_upsert(*merge_sides(spark, sf), ["contact_key"])


@query(
    "merge_upsert_columns",
    with_sql(CONTACTS, TIER, MERGE_SIDES)
    + """SELECT contact_key, COALESCE(i.balance, t.balance) AS balance, COALESCE(i.campaign, t.campaign) AS campaign, t.job, t.y_flag
      FROM target t FULL JOIN incoming i USING (contact_key)""",
)
def merge_upsert_columns(spark: SparkSession, sf: str) -> DataFrame:
    target, incoming = merge_sides(spark, sf)
    kept = target.select("contact_key", "balance", "campaign", "job", "y_flag")
    return joins.merge_upsert(kept, incoming.select("contact_key", "balance", "campaign"), ["contact_key"])


@query(
    "merge_update_only",
    with_sql(SCORED, "late AS (SELECT event_id, 1 - y_flag AS y_flag FROM scored WHERE job = 'click' UNION ALL SELECT -event_id - 1, 1 FROM scored WHERE job = 'view')")
    + "SELECT event_id, job, prediction, COALESCE(late.y_flag, scored.y_flag) AS y_flag FROM scored LEFT JOIN late USING (event_id)",
)
def merge_update_only(spark: SparkSession, sf: str) -> DataFrame:
    log = scored_events(spark, sf).select("event_id", "job", "prediction", "y_flag")
    corrected = log.filter(F.col("job") == "click").select("event_id", (1 - F.col("y_flag")).alias("y_flag"))
    unknown = log.filter(F.col("job") == "view").select((-F.col("event_id") - 1).alias("event_id"), F.lit(1).alias("y_flag"))
    return joins.backfill(log, corrected.unionByName(unknown), ["event_id"], ["y_flag"])


@query(
    "anti_unmatched",
    with_sql(CONTACTS, TIER, MERGE_SIDES)
    + "SELECT contact_key, job, merge_action_note FROM incoming WHERE contact_key NOT IN (SELECT contact_key FROM target)",
)
def anti_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    target, incoming = merge_sides(spark, sf)
    return joins.anti_unmatched(incoming.select("contact_key", "job", "merge_action_note"), target, ["contact_key"])


def segment_model() -> LinearModel:
    return LinearModel(
        -0.4137, {"balance": 0.00071}, {"job": {"BUILDING": 0.313, "MACHINERY": -0.277, "FURNITURE": 0.119}}
    )


SEGMENT_SCORE = """1 / (1 + exp(-(CAST(-0.4137 AS DOUBLE) + CAST(balance AS DOUBLE) * CAST(0.00071 AS DOUBLE)
  + CASE job WHEN 'BUILDING' THEN CAST(0.313 AS DOUBLE) WHEN 'MACHINERY' THEN CAST(-0.277 AS DOUBLE) WHEN 'FURNITURE' THEN CAST(0.119 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)))"""


@query(
    "score_by_key",
    with_sql(_FEATURES)
    + f"""SELECT o_orderkey, ROUND({SEGMENT_SCORE}, 6) AS score,
      CASE WHEN {SEGMENT_SCORE} >= 0.5 THEN CAST(1 AS DOUBLE) WHEN {SEGMENT_SCORE} < 0.5 THEN CAST(0 AS DOUBLE) END AS prediction
      FROM orders LEFT JOIN features ON o_custkey = customer_id""",
)
def by_key(spark: SparkSession, sf: str) -> DataFrame:
    wanted = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"))
    scored = score_by_key(wanted, customer_features(spark, sf), "customer_id", segment_model())
    return scored.select("o_orderkey", F.round("score", 6).alias("score"), "prediction")


@query(
    "scalar_lookup",
    """SELECT event_id, (SELECT max(ts) FROM events) + INTERVAL 1 DAY AS drift_ts,
      CASE WHEN ts = (SELECT max(ts) FROM events) THEN 1 ELSE 0 END AS is_latest FROM events""",
)
def scalar_lookup(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    latest = events.agg(F.max("ts").alias("max_ts")).scalar()
    return events.select(
        "event_id", (latest + F.expr("INTERVAL 1 DAY")).alias("drift_ts"), rules.flag(F.col("ts") == latest).alias("is_latest")
    )
