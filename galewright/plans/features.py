"""Scalar functions and feature rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galewright.functions import rules
from galewright.functions.hashing import weighted_choice
from galewright.functions.numeric import half_up, one_day_later, shift_seconds, to_number, utc_instant
from galewright.plans.registration import CONTACTS, CUT, RATIO, SCORED, TIER, share_sql, query, with_sql
from galewright.sources.fixtures import contacts, scored_events, table


@query("binary_flag", with_sql(CONTACTS, TIER) + "SELECT contact_key, y, CASE WHEN y = 'yes' THEN 1 ELSE 0 END AS y_flag FROM contacts")
def binary_flag(spark: SparkSession, sf: str) -> DataFrame:
    return contacts(spark, sf).select("contact_key", "y", rules.flag(rules.yes("y")).alias("y_flag"))


def _banded(spark: SparkSession, sf: str, age: rules.Bands, balance: rules.Bands, duration: rules.Bands) -> DataFrame:
    return contacts(spark, sf).select(
        "contact_key",
        rules.band("age", age).alias("age_group"),
        rules.band("balance", balance).alias("balance_tier"),
        rules.band("duration", duration).alias("duration_bucket"),
    )


_BANDS = "SELECT contact_key, age_group, balance_tier, duration_bucket FROM "
# The shared SQL of the first two rule sets filters adults; the band functions alone do not.
_TIER_ALL, _CUT_ALL = TIER.replace(" WHERE age >= 18", ""), CUT.replace(" WHERE age >= 18", "")


@query("bucketize_left", with_sql(CONTACTS, _TIER_ALL) + _BANDS + "tier")
def bucketize_left(spark: SparkSession, sf: str) -> DataFrame:
    return _banded(spark, sf, rules.TIER_AGE, rules.TIER_BALANCE, rules.TIER_DURATION)


@query("bucketize_right", with_sql(CONTACTS, _CUT_ALL) + _BANDS + "cut")
def bucketize_right(spark: SparkSession, sf: str) -> DataFrame:
    return _banded(spark, sf, rules.CUT_AGE, rules.CUT_BALANCE, rules.CUT_DURATION)


@query("bucketize_mixed", with_sql(CONTACTS, RATIO) + _BANDS + "ratio")
def bucketize_mixed(spark: SparkSession, sf: str) -> DataFrame:
    return _banded(spark, sf, rules.RATIO_AGE, rules.RATIO_BALANCE, rules.RATIO_DURATION)


@query(
    "contact_intensity_tier",
    with_sql(CONTACTS)
    + """SELECT contact_key, CASE WHEN campaign <= 1 THEN 'low' WHEN campaign <= 3 THEN 'high' ELSE 'high' END AS tier_three_arms,
      CASE WHEN campaign <= 1 THEN 'low' ELSE 'high' END AS tier_two_arms FROM contacts""",
)
def contact_intensity_tier(spark: SparkSession, sf: str) -> DataFrame:
    return contacts(spark, sf).select(
        "contact_key",
        rules.band("campaign", rules.TIER_CAMPAIGN).alias("tier_three_arms"),
        rules.band("campaign", rules.CUT_CAMPAIGN).alias("tier_two_arms"),
    )


@query("contact_ratio", with_sql(CONTACTS, RATIO) + "SELECT contact_key, contact_intensity AS contact_ratio FROM ratio")
def contact_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return contacts(spark, sf).select("contact_key", half_up(rules.contact_ratio()).alias("contact_ratio"))


@query(
    "contacted_flag",
    with_sql(CONTACTS)
    + """SELECT contact_key, CASE WHEN pdays = -1 THEN 0 ELSE 1 END AS contacted,
      CASE WHEN pdays <> -1 THEN 1 ELSE 0 END AS contacted_strict FROM contacts""",
)
def contacted_flag(spark: SparkSession, sf: str) -> DataFrame:
    return contacts(spark, sf).select(
        "contact_key",
        rules.contacted_before().alias("contacted"),
        rules.contacted_before_strict().alias("contacted_strict"),
    )


@query("recency_tier", with_sql(CONTACTS, _TIER_ALL) + "SELECT contact_key, recency_score FROM tier")
def recency_tier(spark: SparkSession, sf: str) -> DataFrame:
    return contacts(spark, sf).select("contact_key", rules.recency_tier().alias("recency_score"))


@query("recency_inverse", with_sql(CONTACTS, RATIO) + "SELECT contact_key, recency_score FROM ratio")
def recency_inverse(spark: SparkSession, sf: str) -> DataFrame:
    return contacts(spark, sf).select("contact_key", half_up(rules.recency_inverse()).alias("recency_score"))


@query("financial_stress_tier", with_sql(CONTACTS, _TIER_ALL) + "SELECT contact_key, financial_stress FROM tier")
def financial_stress_tier(spark: SparkSession, sf: str) -> DataFrame:
    return contacts(spark, sf).select("contact_key", rules.stress_tier().alias("financial_stress"))


@query("financial_stress_flag", with_sql(CONTACTS, RATIO) + "SELECT contact_key, financial_stress FROM ratio")
def financial_stress_flag(spark: SparkSession, sf: str) -> DataFrame:
    return contacts(spark, sf).select("contact_key", rules.stress_flag().alias("financial_stress"))


@query("preset_v1_tier", with_sql(CONTACTS, TIER) + "SELECT * FROM tier")
def preset_v1_tier(spark: SparkSession, sf: str) -> DataFrame:
    return rules.presets()["v1_tier"].apply(contacts(spark, sf))


@query("preset_v1_cut", with_sql(CONTACTS, CUT) + "SELECT * FROM cut")
def preset_v1_cut(spark: SparkSession, sf: str) -> DataFrame:
    return rules.presets()["v1_cut"].apply(contacts(spark, sf))


@query("preset_v2_ratio", with_sql(CONTACTS, RATIO) + "SELECT * FROM ratio")
def preset_v2_ratio(spark: SparkSession, sf: str) -> DataFrame:
    featured = rules.presets()["v2_ratio"].apply(contacts(spark, sf))
    return featured.withColumns({c: half_up(c) for c in ("contact_intensity", "recency_score")})


@query(
    "casts",
    """SELECT event_id, CAST(event_id AS INTEGER) AS as_int, CAST(FLOOR(value) AS BIGINT) AS as_long,
      CAST(user_id AS DOUBLE) AS as_double, CAST(user_id AS VARCHAR) AS as_string,
      CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS as_timestamp FROM events""",
)
def casts(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return events.select(
        "event_id",
        F.col("event_id").try_cast("int").alias("as_int"),
        F.floor("value").cast("bigint").alias("as_long"),
        F.col("user_id").cast("double").alias("as_double"),
        F.col("user_id").cast("string").alias("as_string"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz").alias("as_timestamp"),
    )


@query(
    "arithmetic_update",
    with_sql(CONTACTS)
    + """SELECT contact_key, balance + 2000 AS balance, duration + 60 AS duration, campaign + 1 AS campaign
      FROM contacts WHERE job = 'BUILDING'""",
)
def arithmetic_update(spark: SparkSession, sf: str) -> DataFrame:
    selected = contacts(spark, sf).filter(F.col("job") == "BUILDING")
    return updated(selected).select("contact_key", "balance", "duration", "campaign")


def updated(df: DataFrame) -> DataFrame:
    """The correction applied to contacts that arrive again."""
    return df.withColumns({"balance": F.col("balance") + 2000, "duration": F.col("duration") + 60, "campaign": F.col("campaign") + 1})


@query(
    "greatest_zero",
    with_sql(CONTACTS)
    + "SELECT contact_key, greatest(CAST(balance AS DOUBLE), CAST(0 AS DOUBLE)) AS positive_balance, -greatest(CAST(balance AS DOUBLE), CAST(0 AS DOUBLE)) + CAST(0 AS DOUBLE) AS loss FROM contacts",
)
def greatest_zero(spark: SparkSession, sf: str) -> DataFrame:
    positive = F.greatest(F.col("balance").cast("double"), F.lit(0.0))
    return contacts(spark, sf).select("contact_key", positive.alias("positive_balance"), (-positive + F.lit(0.0)).alias("loss"))


@query(
    "to_numeric_coerce",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, TRY_CAST(t AS DOUBLE) AS parsed FROM (
      SELECT *, CASE WHEN l_returnflag = 'R' THEN concat(' ', CAST(l_linenumber AS VARCHAR), '.5 ') WHEN l_returnflag = 'A' THEN l_linestatus
        ELSE CAST(l_linenumber AS VARCHAR) END AS t FROM lineitem)""",
)
def to_numeric_coerce(spark: SparkSession, sf: str) -> DataFrame:
    number = F.col("l_linenumber").cast("string")
    dirty = (
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit(" "), number, F.lit(".5 ")))
        .when(F.col("l_returnflag") == "A", F.col("l_linestatus"))
        .otherwise(number)
    )
    lines = table(spark, sf, "lineitem").withColumn("t", dirty)
    return lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", to_number("t").alias("parsed"))


@query(
    "time_arithmetic",
    """SELECT event_id, ts + INTERVAL 1 DAY AS next_day,
      ts - to_seconds(user_id * 60) AS moved_back, CAST(floor(epoch(ts)) AS BIGINT) AS unix_seconds FROM events""",
)
def time_arithmetic(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        one_day_later("ts").alias("next_day"),
        shift_seconds("ts", -F.col("user_id") * 60).alias("moved_back"),
        F.unix_seconds(utc_instant("ts")).alias("unix_seconds"),
    )


FORCED = (
    f"CASE WHEN {share_sql('event_id', 'label', 0.8)} THEN 1 ELSE 0 END AS y_flag, "
    f"CASE WHEN {share_sql('event_id', 'prediction', 0.7)} THEN 1 ELSE 0 END AS prediction"
)


@query(
    "weighted_choice",
    with_sql(SCORED)
    + f"""SELECT event_id, inference_timestamp + INTERVAL 1 DAY AS inference_timestamp, job, balance,
      CAST(model_version AS VARCHAR) AS model_version, {FORCED} FROM scored""",
)
def weighted(spark: SparkSession, sf: str) -> DataFrame:
    return forced_rows(scored_events(spark, sf))


def forced_rows(scored: DataFrame) -> DataFrame:
    """The log a day later with labels 8:2 and predictions 7:3, decided by the key."""
    return scored.select(
        "event_id",
        one_day_later("inference_timestamp").alias("inference_timestamp"),
        "job",
        "balance",
        F.col("model_version").cast("string").alias("model_version"),
        weighted_choice("event_id", (1, 0), (8, 2), "label").alias("y_flag"),
        weighted_choice("event_id", (1, 0), (7, 3), "prediction").alias("prediction"),
    )
