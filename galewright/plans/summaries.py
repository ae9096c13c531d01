"""Counts, rates, windows and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galewright.functions import rules
from galewright.functions.numeric import half_up
from galewright.operators import aggregates, keys
from galewright.operators.profile import windowed
from galewright.plans.projecting import tier
from galewright.plans.registration import CONTACTS, SCORED, TIER, digest_sql, query, with_sql
from galewright.sources.fixtures import contacts, scored_events, table


@query("count_by", with_sql(CONTACTS) + "SELECT y, count(*) AS row_count FROM contacts GROUP BY y")
def count_by(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.count_by(contacts(spark, sf), "y")


@query(
    "class_balance",
    with_sql(CONTACTS, TIER)
    + """SELECT age_group, y_flag, count(*) AS row_count, ROUND(avg(balance), 6) AS avg_balance, ROUND(avg(duration), 6) AS avg_duration
      FROM tier GROUP BY age_group, y_flag ORDER BY age_group, y_flag""",
)
def class_balance(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: contacts → adults → features → class balance per age group."""
    summary = aggregates.means_by(tier(spark, sf), ["age_group", "y_flag"], ["balance", "duration"])
    return summary.withColumns({c: half_up(c) for c in ("avg_balance", "avg_duration")})


@query(
    "rate_by_flag",
    with_sql(CONTACTS, TIER)
    + """SELECT was_previously_contacted, count(*) AS row_count, ROUND(avg(y_flag), 6) AS subscription_rate
      FROM tier GROUP BY was_previously_contacted""",
)
def rate_by_flag(spark: SparkSession, sf: str) -> DataFrame:
    return tier(spark, sf).groupBy("was_previously_contacted").agg(
        F.count(F.lit(1)).alias("row_count"), half_up(F.avg("y_flag")).alias("subscription_rate")
    )


@query("global_count", with_sql(CONTACTS) + "SELECT count(*) AS row_count FROM contacts WHERE age >= 18")
def global_count(spark: SparkSession, sf: str) -> DataFrame:
    adults = contacts(spark, sf).filter(F.col("age") >= rules.MINIMUM_AGE)
    return adults.agg(F.count(F.lit(1)).alias("row_count"))


@query("distinct_count", with_sql(CONTACTS) + "SELECT count(DISTINCT balance) AS distinct_balances, count(DISTINCT job) AS distinct_jobs FROM contacts")
def distinct_count(spark: SparkSession, sf: str) -> DataFrame:
    return contacts(spark, sf).agg(
        F.count_distinct("balance").alias("distinct_balances"), F.count_distinct("job").alias("distinct_jobs")
    )


@query("min_max", "SELECT min(ts) AS min_ts, max(ts) AS max_ts FROM events")
def min_max(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").agg(F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"))


@query(
    "value_counts_normalized",
    with_sql(CONTACTS)
    + "SELECT y, count(*) AS row_count, ROUND(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share FROM contacts GROUP BY y",
)
def value_counts_normalized(spark: SparkSession, sf: str) -> DataFrame:
    shares = aggregates.class_shares(contacts(spark, sf), "y")
    return shares.withColumn("share", half_up("share"))


@query(
    "non_null_counts",
    with_sql(CONTACTS)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({e}) AS non_null FROM contacts"
        for c, e in {"contact_key": "contact_key", "job": "job", "pdays": "NULLIF(pdays, -1)", "y": "y"}.items()
    ),
)
def non_null_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = contacts(spark, sf).withColumn("pdays", F.nullif(F.col("pdays"), F.lit(rules.NEVER_CONTACTED)))
    return aggregates.non_null_counts(rows, ["contact_key", "job", "pdays", "y"])


@query("overall_rate", with_sql(CONTACTS, TIER) + "SELECT ROUND(avg(y_flag), 6) AS positive_rate FROM tier")
def overall_rate(spark: SparkSession, sf: str) -> DataFrame:
    return tier(spark, sf).agg(half_up(F.avg("y_flag")).alias("positive_rate"))


_ORDER = ["age", "job", "balance", "duration", "campaign", "pdays", "previous", "y", "contact_key"]


@query(
    "global_row_number",
    with_sql(CONTACTS) + f"SELECT *, CAST(row_number() OVER (ORDER BY {', '.join(_ORDER)}) AS BIGINT) AS contact_id FROM contacts",
)
def global_row_number(spark: SparkSession, sf: str) -> DataFrame:
    return keys.global_row_number(contacts(spark, sf), _ORDER, "contact_id")


@query(
    "positional_row_number",
    with_sql(SCORED) + "SELECT event_id, CAST(row_number() OVER (ORDER BY event_id) AS BIGINT) AS row_num FROM scored",
)
def positional_row_number(spark: SparkSession, sf: str) -> DataFrame:
    return keys.global_row_number(scored_events(spark, sf).select("event_id"), ["event_id"])


_KEY_COLUMNS = ["job", "housing", "loan", "y", "previous"]
_ROW_HASH = f"md5(concat_ws('|', {', '.join(f'CAST({c} AS VARCHAR)' for c in [*_KEY_COLUMNS, 'contact_key'])}))"


@query(
    "stable_key",
    with_sql(CONTACTS)
    + f"SELECT {_ROW_HASH} AS stable_key, contact_key, job FROM contacts",
)
def stable_key(spark: SparkSession, sf: str) -> DataFrame:
    keyed = keys.stable_key(contacts(spark, sf), _KEY_COLUMNS, "contact_key")
    return keyed.select("stable_key", "contact_key", "job")


@query(
    "row_number_by_digest",
    f"""SELECT event_id, event_type, CAST(row_number() OVER (PARTITION BY event_type ORDER BY {digest_sql('event_id', 'rank')}, event_id) AS BIGINT)
      AS rank_in_group FROM events""",
)
def row_number_by_digest(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "event_type")
    return keys.row_number_by_digest(events, "event_type", "event_id")


@query(
    "tumbling_day",
    with_sql(SCORED)
    + """SELECT date_trunc('day', inference_timestamp) AS window_start, date_trunc('day', inference_timestamp) + INTERVAL 1 DAY AS window_end,
      count(*) AS row_count FROM scored GROUP BY ALL""",
)
def tumbling_day(spark: SparkSession, sf: str) -> DataFrame:
    days = windowed(scored_events(spark, sf), "inference_timestamp")
    return days.groupBy("window_start", "window_end").agg(F.count(F.lit(1)).alias("row_count"))
