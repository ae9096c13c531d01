"""Scans, sinks and versioned tables. Each query writes below the shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galewright.functions import rules
from galewright.operators import joins
from galewright.operators.sampling import hash_sample, stratified_split
from galewright.plans.features import FORCED, forced_rows
from galewright.plans.joining import MERGE_SIDES, MERGED_ROWS, merge_sides
from galewright.plans.projecting import tier
from galewright.plans.registration import CONTACTS, RATIO, SCORED, TIER, share_sql, digest_sql, query, with_sql
from galewright.session import fresh_path
from galewright.sources import inference, readers, sinks
from galewright.sources.fixtures import contacts, scored_events, table
from galewright.sources.keyed import BucketedTable
from galewright.sources.snapshots import SnapshotTable

_NOTED = "target AS (SELECT *, 'original record' AS merge_action_note FROM tier)"


@query("scan_csv", with_sql(CONTACTS) + "SELECT * FROM contacts")
def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    rows = contacts(spark, sf)
    path = fresh_path(spark, "csv")
    rows.write.option("sep", ";").option("header", True).csv(path)
    return readers.read_delimited(spark, path, rows.schema)


# Values of several types in one column, as files that grew over years have them.
_RAGGED = """ragged AS (SELECT contact_key, CAST(age AS VARCHAR) AS age,
  CASE WHEN contact_key % 97 = 5 THEN CAST(CAST(balance AS BIGINT) * 4000000000 AS VARCHAR) ELSE CAST(balance AS VARCHAR) END AS balance,
  CASE WHEN contact_key % 1000 = 7 THEN concat(CAST(duration AS VARCHAR), '.5') WHEN contact_key % 50 = 3 THEN '' ELSE CAST(duration AS VARCHAR) END AS duration,
  CASE WHEN contact_key % 500 = 9 THEN 'unknown' ELSE CAST(campaign AS VARCHAR) END AS campaign,
  CASE WHEN housing = 'yes' THEN 'true' ELSE 'FALSE' END AS housing,
  CASE WHEN contact_key % 300 = 11 THEN concat('2024-01-', CAST(10 + campaign AS VARCHAR), ' 12:30:00') ELSE concat('2024-02-', CAST(10 + campaign AS VARCHAR)) END AS seen FROM contacts)"""
_RAGGED_COLUMNS = ("age", "balance", "duration", "campaign", "housing", "seen")
_NARROWEST = """CASE WHEN regexp_matches(v, '^[+-]?[0-9]{1,18}$') THEN CASE WHEN CAST(v AS BIGINT) BETWEEN -2147483648 AND 2147483647 THEN 'int' ELSE 'bigint' END
  WHEN regexp_matches(v, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$') THEN 'double' WHEN regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN 'date'
  WHEN regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9:]{8}$') THEN 'timestamp_ntz' WHEN lower(v) IN ('true', 'false') THEN 'boolean' ELSE 'string' END"""


@query(
    "scan_csv_inferred",
    with_sql(
        CONTACTS,
        _RAGGED,
        "cells AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, contact_key, {c} AS v FROM ragged" for c in _RAGGED_COLUMNS) + ")",
        f"met AS (SELECT column_name, {_NARROWEST} AS narrowest, count(*) AS row_count, min(contact_key) AS first_key FROM cells WHERE v <> '' GROUP BY ALL)",
        """types AS (SELECT column_name, CASE WHEN bool_and(narrowest = 'int') THEN 'int' WHEN bool_and(narrowest IN ('int', 'bigint')) THEN 'bigint'
      WHEN bool_and(narrowest IN ('int', 'bigint', 'double')) THEN 'double' WHEN bool_and(narrowest = 'date') THEN 'date'
      WHEN bool_and(narrowest IN ('date', 'timestamp_ntz')) THEN 'timestamp_ntz' WHEN bool_and(narrowest = 'boolean') THEN 'boolean' ELSE 'string' END AS inferred FROM met GROUP BY column_name)""",
    )
    + "SELECT column_name, narrowest, row_count, first_key, inferred FROM met JOIN types USING (column_name)",
)
def scan_csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """The types that a delimited file's columns need, and the first row that needed each."""
    select = _RAGGED.split("AS (", 1)[1].rsplit(")", 1)[0].replace("VARCHAR", "STRING").replace("FROM contacts", "FROM {contacts}")
    path = fresh_path(spark, "ragged")
    spark.sql(select, contacts=contacts(spark, sf)).write.option("sep", ";").option("header", True).csv(path)
    texts = inference.read_texts(spark, path).withColumn("contact_key", F.col("contact_key").cast("bigint"))
    return inference.type_report(texts, "contact_key")


@query("scan_table", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def scan_table(spark: SparkSession, sf: str) -> DataFrame:
    return readers.read_table(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_custkey", "o_totalprice"])


_GROUPS = [("purchase", "buying", 3), ("signup", "joining", 2), ("view", "looking", 1), ("click", "looking", 1)]


@query(
    "literal_rows",
    """SELECT event_id, activity, weight FROM events JOIN (VALUES ('purchase', 'buying', 3), ('signup', 'joining', 2), ('view', 'looking', 1),
      ('click', 'looking', 1)) g(event_type, activity, weight) USING (event_type)""",
)
def literal_rows(spark: SparkSession, sf: str) -> DataFrame:
    groups = readers.literal_rows(spark, _GROUPS, "event_type STRING, activity STRING, weight INT")
    return table(spark, sf, "events").join(F.broadcast(groups), "event_type").select("event_id", "activity", "weight")


@query(
    "temp_view_sql",
    with_sql(CONTACTS) + "SELECT job, y, count(*) AS row_count, ROUND(avg(balance), 6) AS avg_balance FROM contacts GROUP BY job, y",
)
def temp_view_sql(spark: SparkSession, sf: str) -> DataFrame:
    contacts(spark, sf).createOrReplaceTempView("galewright_contacts")
    return spark.sql(
        "SELECT job, y, count(*) AS row_count, round(avg(balance), 6) AS avg_balance FROM galewright_contacts GROUP BY job, y"
    )


def _merged_table(spark: SparkSession, sf: str) -> SnapshotTable:
    """Version 0: the target. Version 1: after the merge."""
    target, incoming = merge_sides(spark, sf)
    versions = SnapshotTable(spark, fresh_path(spark, "snapshots"))
    versions.overwrite(target)
    versions.upsert(incoming, ["contact_key"])
    return versions


@query("snapshot_as_of", with_sql(CONTACTS, TIER, _NOTED) + "SELECT * FROM target")
def snapshot_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return _merged_table(spark, sf).as_of(0)


def _merged_features(spark: SparkSession, sf: str) -> BucketedTable:
    """The target in buckets, after the merge of corrected and new rows."""
    target, incoming = merge_sides(spark, sf)
    features = BucketedTable(spark, fresh_path(spark, "features"), ["contact_key"], buckets=16)
    features.create(target)
    features.merge(incoming, "corrections")
    return features


@query("feature_upsert", with_sql(CONTACTS, TIER, MERGE_SIDES) + MERGED_ROWS)
def feature_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return _merged_features(spark, sf).rows()


_LATE_CALLS = """late AS (SELECT contact_key, balance - 1 AS balance FROM target WHERE contact_key % 1000 = 7)"""


@query(
    "feature_upsert_columns",
    with_sql(CONTACTS, TIER, MERGE_SIDES, f"merged AS ({MERGED_ROWS})", _LATE_CALLS)
    + "SELECT merged.* REPLACE (COALESCE(late.balance, merged.balance) AS balance) FROM merged LEFT JOIN late USING (contact_key)",
)
def feature_upsert_columns(spark: SparkSession, sf: str) -> DataFrame:
    """A second, small merge of one column into the buckets that its keys touch."""
    features = _merged_features(spark, sf)
    late = merge_sides(spark, sf)[0].filter(F.col("contact_key") % 1000 == 7)
    features.merge(late.select("contact_key", (F.col("balance") - 1).alias("balance")), "late")
    return features.rows()


@query(
    "table_history",
    with_sql(CONTACTS, TIER, MERGE_SIDES, f"merged AS ({MERGED_ROWS})")
    + """SELECT 0 AS snapshot_version, 'overwrite' AS operation, count(*) AS row_count FROM target
      UNION ALL SELECT 1, 'merge', count(*) FROM merged""",
)
def table_history(spark: SparkSession, sf: str) -> DataFrame:
    return _merged_table(spark, sf).history()


_CHANGED = "SELECT contact_key, balance, campaign, merge_action_note"
_CHANGES = (
    with_sql(CONTACTS, TIER, MERGE_SIDES)
    + f"""{_CHANGED}, 'update_preimage' AS change_type FROM target WHERE contact_key IN (SELECT contact_key FROM incoming)
      UNION ALL {_CHANGED}, CASE WHEN contact_key < 0 THEN 'insert' ELSE 'update_postimage' END FROM incoming"""
)


@query("change_feed", _CHANGES)
def change_feed(spark: SparkSession, sf: str) -> DataFrame:
    """What the merge itself wrote."""
    changes = _merged_features(spark, sf).changes("corrections")
    return changes.select("contact_key", "balance", "campaign", "merge_action_note", "change_type")


@query("change_feed_versions", _CHANGES)
def change_feed_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of a table that kept no changes."""
    versions = _merged_table(spark, sf)
    changes = joins.change_feed(versions.as_of(0), versions.as_of(1), ["contact_key"])
    return changes.select("contact_key", "balance", "campaign", "merge_action_note", "change_type")


@query("sink_overwrite", with_sql(CONTACTS, RATIO) + "SELECT contact_key, age_group, contact_intensity FROM ratio")
def sink_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """The second write has another schema than the first."""
    output = SnapshotTable(spark, fresh_path(spark, "overwrite"))
    output.overwrite(tier(spark, sf))
    featured = rules.presets()["v2_ratio"].apply(contacts(spark, sf))
    output.overwrite(featured.select("contact_key", "age_group", F.round("contact_intensity", 6).alias("contact_intensity")))
    return output.as_of()


@query("sink_overwrite_strict", with_sql(CONTACTS, TIER) + "SELECT * FROM tier WHERE y_flag = 1")
def sink_overwrite_strict(spark: SparkSession, sf: str) -> DataFrame:
    """The second write must have the schema of the first."""
    output = SnapshotTable(spark, fresh_path(spark, "strict"))
    output.overwrite(tier(spark, sf))
    output.overwrite(output.as_of().filter(F.col("y_flag") == 1), keep_schema=True)
    return output.as_of()


@query(
    "sink_append",
    with_sql(SCORED)
    + f"""SELECT event_id, inference_timestamp, job, balance, CAST(model_version AS VARCHAR) AS model_version, y_flag, prediction FROM scored
      UNION ALL SELECT event_id, inference_timestamp + INTERVAL 1 DAY, job, balance, CAST(model_version AS VARCHAR), {FORCED} FROM scored""",
)
def sink_append(spark: SparkSession, sf: str) -> DataFrame:
    """The whole log, to which the log of a day later is appended."""
    log = scored_events(spark, sf).withColumn("model_version", F.col("model_version").cast("string"))
    path = fresh_path(spark, "append")
    log.write.parquet(path)
    sinks.append(forced_rows(scored_events(spark, sf)), path)
    return spark.read.schema(log.schema).parquet(path)


@query("create_or_replace_as", with_sql(SCORED) + f"SELECT * EXCLUDE (inference_timestamp) FROM scored WHERE {share_sql('event_id', 42, 0.2)}")
def create_or_replace_as(spark: SparkSession, sf: str) -> DataFrame:
    """The monitoring baseline: a 20 % sample without the timestamp."""
    baseline = hash_sample(scored_events(spark, sf), "event_id", 0.2).drop("inference_timestamp")
    return sinks.create_or_replace_table(baseline, "galewright_baseline", fresh_path(spark, "baseline"))


@query(
    "dry_run_sink",
    with_sql(CONTACTS, TIER) + "SELECT 0 AS written, count(*) AS row_count FROM tier UNION ALL SELECT 1, count(*) FROM tier",
)
def dry_run_sink(spark: SparkSession, sf: str) -> DataFrame:
    rows = tier(spark, sf)
    return sinks.write_or_count(rows, dry_run=True).unionByName(sinks.write_or_count(rows, dry_run=False))


@query(
    "train_test_tables",
    with_sql(
        CONTACTS,
        TIER,
        f"ranked AS (SELECT *, row_number() OVER (PARTITION BY y_flag ORDER BY {digest_sql('contact_key', 42)}, contact_key) AS r, count(*) OVER (PARTITION BY y_flag) AS n FROM tier)",
    )
    + """SELECT CASE WHEN r <= ceil(n * 20 / 100.0) THEN 'test' ELSE 'train' END AS split, y_flag, count(*) AS row_count, CAST(sum(balance) AS BIGINT) AS balance_sum
      FROM ranked GROUP BY ALL""",
)
def train_test_tables(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "splits")
    sinks.write_splits(stratified_split(tier(spark, sf), "contact_key", "y_flag"), path)
    parts = [
        sinks.read_split(spark, path, name)
        .groupBy("y_flag")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("balance").alias("balance_sum"))
        .withColumn("split", F.lit(name))
        for name in ("train", "test")
    ]
    return parts[0].unionByName(parts[1])
