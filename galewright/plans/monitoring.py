"""Profile and drift tables of the scored log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galewright.functions.hashing import digest, lowest_share
from galewright.functions.templates import missed_value_metric
from galewright.operators import drift, profile
from galewright.operators.sampling import hash_sample
from galewright.plans.features import FORCED, forced_rows
from galewright.plans.quality import (
    ACCURACY, F1, F1_ZERO, LABEL, MODEL, PRECISION, PRECISION_ZERO, PREDICTION, RECALL, RECALL_ZERO, TIME, rounded,
)
from galewright.plans.registration import CONTACTS, SCORED, share_sql, query, with_sql
from galewright.session import materialize
from galewright.sources.fixtures import SCORED_COLUMNS, contacts, table, scored_events

_SLICES = ["job", "balance >= 100"]
_SLICED = """sliced AS (SELECT date_trunc('day', inference_timestamp) AS window_start, * FROM (
    SELECT ':all' AS slice_key, ':all' AS slice_value, * FROM scored
    UNION ALL SELECT 'job', job, * FROM scored
    UNION ALL SELECT 'balance >= 100', CAST(balance >= 100 AS VARCHAR), * FROM scored))"""
_GROUP = "window_start, window_start + INTERVAL 1 DAY AS window_end, model_version, slice_key, slice_value"
_MISSED = "avg(CASE WHEN y_flag = 1 AND prediction <> y_flag THEN -greatest(balance, CAST(0 AS DOUBLE)) ELSE CAST(0 AS DOUBLE) END)"
_CELLS = f"""cells AS (SELECT {_GROUP}, CAST(count(*) AS DOUBLE) AS n, {_MISSED} AS missed,
    CAST(count(*) FILTER (y_flag = 1 AND prediction = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (y_flag = 0 AND prediction = 1) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (y_flag = 1 AND prediction = 0) AS DOUBLE) AS fn, CAST(count(*) FILTER (y_flag = 0 AND prediction = 0) AS DOUBLE) AS tn,
    CAST(count(balance) AS DOUBLE) AS b_n, CAST(count(*) - count(balance) AS DOUBLE) AS b_null, min(balance) AS b_min, max(balance) AS b_max,
    avg(balance) AS b_mean, stddev_samp(balance) AS b_std, CAST(count(job) AS DOUBLE) AS j_n, CAST(count(*) - count(job) AS DOUBLE) AS j_null
    FROM sliced GROUP BY window_start, model_version, slice_key, slice_value)"""
_KEYS = "window_start, window_end, model_version, slice_key, slice_value"


def _metric_rows(metrics: dict[tuple[str, str], str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {_KEYS}, '{c}' AS column_name, '{m}' AS metric, ROUND({e}, 6) AS value FROM cells" for (c, m), e in metrics.items()
    )


def _weighted(one: str, zero: str) -> str:
    """The mean of both classes' metric, weighted by their labels."""
    return f"COALESCE(({one} * (tp + fn) + {zero} * (tn + fp)) / NULLIF(tp + fp + fn + tn, 0), 0)"


_QUALITY = {
    (":table", "count"): "n",
    (":table", "accuracy"): ACCURACY,
    (":table", "precision"): PRECISION,
    (":table", "recall"): RECALL,
    (":table", "f1"): F1,
    (":table", "weighted_precision"): _weighted(PRECISION, PRECISION_ZERO),
    (":table", "weighted_recall"): _weighted(RECALL, RECALL_ZERO),
    (":table", "weighted_f1"): _weighted(F1, F1_ZERO),
    (":table", "macro_f1"): f"COALESCE(({F1} + {F1_ZERO}) / NULLIF(CAST(tp + fp + fn > 0 AS INT) + CAST(tn + fp + fn > 0 AS INT), 0), 0)",
    (":table", "missed_value"): "missed",
}
_COLUMN_CELLS = {
    ("balance", "non_null"): "b_n",
    ("balance", "num_nulls"): "b_null",
    ("balance", "min"): "b_min",
    ("balance", "max"): "b_max",
    ("balance", "mean"): "b_mean",
    ("balance", "stddev"): "b_std",
    ("job", "non_null"): "j_n",
    ("job", "num_nulls"): "j_null",
}


@query("profile_sliced", with_sql(SCORED, _SLICED, _CELLS) + _metric_rows(_QUALITY))
def profile_sliced(spark: SparkSession, sf: str) -> DataFrame:
    rows = profile.profile_metrics(
        scored_events(spark, sf), TIME, MODEL, LABEL, PREDICTION, _SLICES, custom=[missed_value_metric("balance")]
    )
    return rounded(rows, "value")


@query("profile_columns", with_sql(SCORED, _SLICED, _CELLS) + _metric_rows(_QUALITY | _COLUMN_CELLS))
def profile_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = profile.profile_metrics(
        scored_events(spark, sf), TIME, MODEL, LABEL, PREDICTION, _SLICES, ["balance", "job"], [missed_value_metric("balance")]
    )
    return rounded(rows, "value")


@query(
    "slice_grouping_sets",
    with_sql(SCORED, _SLICED)
    + "SELECT model_version, slice_key, slice_value, count(*) AS row_count, ROUND(avg(balance), 6) AS avg_balance FROM sliced GROUP BY ALL",
)
def slice_grouping_sets(spark: SparkSession, sf: str) -> DataFrame:
    return _slices(spark, sf)


@query(
    "slice_exploded",
    with_sql(SCORED, _SLICED)
    + "SELECT model_version, slice_key, slice_value, count(*) AS row_count, ROUND(avg(balance), 6) AS avg_balance FROM sliced GROUP BY ALL",
)
def slice_exploded(spark: SparkSession, sf: str) -> DataFrame:
    return _slices(spark, sf)


_SEEN = ["user_id", "job", "balance"]


@query(
    "distinct_from_days",
    with_sql(
        SCORED.replace("FROM events", ", user_id FROM events"),
        _SLICED,
    )
    + " UNION ALL ".join(
        f"SELECT model_version, slice_key, slice_value, '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count FROM sliced "
        f"WHERE window_start >= TIMESTAMP '2024-01-08 00:00:00' GROUP BY ALL"
        for c in _SEEN
    ),
)
def distinct_from_days(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct values of all days from the second week on, from the sketches kept for each day."""
    named = [F.expr(e).alias(n) for n, e in SCORED_COLUMNS.items()]
    log = table(spark, sf, "events").select(*named, "user_id")
    kept = materialize(profile.daily_sketches(log, TIME, MODEL, _SEEN, _SLICES), "sketches")
    late = kept.filter(F.col("window_start") >= F.expr("timestamp_ntz'2024-01-08 00:00:00'"))
    return profile.merged_distinct(late, [MODEL, "slice_key", "slice_value"])


def _slices(spark: SparkSession, sf: str) -> DataFrame:
    aggregates = [F.count(F.lit(1)).alias("row_count"), F.avg("balance").alias("avg_balance")]
    grouped = profile.sliced_agg(scored_events(spark, sf), [MODEL], _SLICES, aggregates)
    return rounded(grouped, "avg_balance")


def _profile_sql(columns: dict[str, bool]) -> str:
    parts = []
    for c, numeric in columns.items():
        x = f"CAST({c} AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS num_nulls, count(DISTINCT {c}) AS distinct_count, "
            f"ROUND(min({x}), 6) AS min_value, ROUND(max({x}), 6) AS max_value, ROUND(avg({x}), 6) AS mean_value, ROUND(stddev_samp({x}), 6) AS stddev_value FROM contacts"
        )
    return " UNION ALL ".join(parts)


_PROFILED = {"age": True, "job": False, "balance": True, "duration": True, "pdays": True, "y": False}


@query("column_profile", with_sql(CONTACTS) + _profile_sql(_PROFILED))
def column_profile(spark: SparkSession, sf: str) -> DataFrame:
    wide = profile.column_profile(contacts(spark, sf), list(_PROFILED), exact_distinct=True)
    return rounded(wide, "min_value", "max_value", "mean_value", "stddev_value")


# Baseline: the first week of the log. Current: all later weeks.
_WEEK = "TIMESTAMP '2024-01-08 00:00:00'"
_BASE = f"base AS (SELECT * FROM scored WHERE inference_timestamp < {_WEEK})"
_NOW = f"now AS (SELECT * FROM scored WHERE inference_timestamp >= {_WEEK})"
_DRIFT_COLUMNS = ["job", "y_flag", "prediction"]


def _values(source: str, columns: list[str], keep: str = "") -> str:
    return " UNION ALL ".join(f"SELECT {keep}'{c}' AS column_name, COALESCE(CAST({c} AS VARCHAR), 'null') AS category FROM {source}" for c in columns)


def _drift_sql(group: str) -> str:
    """Named queries from ``m`` (group…, category, nb, nc) to ``d`` (group…, all distances)."""
    return f"""
    t AS (SELECT *, CAST(sum(nb) OVER w AS DOUBLE) AS bt, CAST(sum(nc) OVER w AS DOUBLE) AS ct FROM m WINDOW w AS (PARTITION BY {group})),
    s AS (SELECT *, nb / NULLIF(bt, 0) AS p, nc / NULLIF(ct, 0) AS q, (nb + nc) * bt / (bt + ct) AS eb, (nb + nc) * ct / (bt + ct) AS ec FROM t),
    d AS (SELECT {group}, sqrt(greatest(0, (sum(CASE WHEN p > 0 THEN p * log2(p * 2 / (p + q)) ELSE 0 END)
        + sum(CASE WHEN q > 0 THEN q * log2(q * 2 / (p + q)) ELSE 0 END)) / 2)) AS js, sum(abs(p - q)) / 2 AS tv, max(abs(p - q)) AS linf,
        sum((nb - eb) * (nb - eb) / NULLIF(eb, 0) + (nc - ec) * (nc - ec) / NULLIF(ec, 0)) AS chi2,
        count(*) FILTER (nb + nc > 0) - 1 AS df, CAST(max(bt) AS BIGINT) AS baseline_rows, CAST(max(ct) AS BIGINT) AS current_rows FROM s GROUP BY {group})"""


# P(X >= x) as 1 minus the series of the regularised lower incomplete gamma function.
_PVALUE = """CASE WHEN df <= 0 OR chi2 <= 0 THEN CAST(1 AS DOUBLE) ELSE greatest(CAST(0 AS DOUBLE), 1 - (SELECT sum(exp((df / 2.0 + i) * ln(chi2 / 2) - chi2 / 2 - lgamma(CAST(df / 2.0 + i + 1 AS DOUBLE))))
    FROM range(0, 6000) r(i))) END"""

_MERGED = f"""b AS (SELECT column_name, category, count(*) AS n FROM ({_values('base', _DRIFT_COLUMNS)}) GROUP BY ALL),
    k AS (SELECT column_name, category, count(*) AS n FROM ({_values('now', _DRIFT_COLUMNS)}) GROUP BY ALL),
    m AS (SELECT column_name, category, COALESCE(b.n, 0) AS nb, COALESCE(k.n, 0) AS nc FROM b FULL JOIN k USING (column_name, category))"""


def _two_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    log = scored_events(spark, sf)
    first_week = F.col(TIME) < F.expr("timestamp_ntz'2024-01-08 00:00:00'")
    return log.filter(first_week), log.filter(~first_week)


# Baseline: the log's 20 % digest sample, as ``create_or_replace_as`` writes it. Current: the whole log a day later, with forced labels and predictions.
_SAMPLED = f"base AS (SELECT * FROM scored WHERE {share_sql('event_id', 42, 0.2)})"
_FORCED = f"now AS (SELECT event_id, inference_timestamp + INTERVAL 1 DAY AS inference_timestamp, job, balance, model_version, {FORCED} FROM scored)"


@query(
    "merge_on_category",
    with_sql(SCORED, _SAMPLED, _FORCED, _MERGED)
    + "SELECT column_name, category, CAST(nb AS BIGINT) AS baseline_n, CAST(nc AS BIGINT) AS current_n FROM m",
)
def merge_on_category(spark: SparkSession, sf: str) -> DataFrame:
    log = scored_events(spark, sf)
    return drift.merge_on_category(hash_sample(log, "event_id", 0.2), forced_rows(log), _DRIFT_COLUMNS)


def _register_drift(key: str, column: str, expression: str) -> None:
    sql = with_sql(SCORED, _BASE, _NOW, _MERGED, _drift_sql("column_name")) + f"SELECT column_name, ROUND({expression}, 6) AS {column} FROM d"

    @query(key, sql)
    def build(spark: SparkSession, sf: str) -> DataFrame:
        wide = drift.drift(*_two_sides(spark, sf), _DRIFT_COLUMNS)
        return rounded(wide.select("column_name", column), column)


_register_drift("drift_tv", "tv_distance", "tv")
_register_drift("drift_linf", "l_infinity", "linf")
_register_drift("drift_js", "js_distance", "js")
_register_drift("drift_chi2", "chi_squared", "chi2")


# Two halves of one log differ by chance only, which keeps the p-values away from 0.
_HALVES = with_sql(
    SCORED,
    f"base AS (SELECT * FROM scored WHERE {share_sql('event_id', 'half', 0.5)})",
    f"now AS (SELECT * FROM scored WHERE NOT {share_sql('event_id', 'half', 0.5)})",
    _MERGED,
    _drift_sql("column_name"),
)


@query("drift_chi2_pvalue", _HALVES + f"SELECT column_name, CAST(df AS BIGINT) AS degrees_of_freedom, ROUND({_PVALUE}, 6) AS chi_squared_pvalue FROM d")
def drift_chi2_pvalue(spark: SparkSession, sf: str) -> DataFrame:
    log = scored_events(spark, sf)
    lower = lowest_share(digest("event_id", salt="half"), 0.5)
    wide = drift.drift(log.filter(lower), log.filter(~lower), _DRIFT_COLUMNS)
    return rounded(wide.select("column_name", "degrees_of_freedom", "chi_squared_pvalue"), "chi_squared_pvalue")


_LOG_SLICED = """{name}_sliced AS (SELECT ':all' AS slice_key, ':all' AS slice_value, * FROM {name}
    UNION ALL SELECT 'job', job, * FROM {name} UNION ALL SELECT 'balance >= 100', CAST(balance >= 100 AS VARCHAR), * FROM {name})"""
_WINDOW_KEYS = "window_start, window_end, model_version, slice_key, slice_value"
_WINDOWED_DRIFT = with_sql(
    SCORED,
    _BASE,
    _NOW,
    _LOG_SLICED.format(name="base"),
    _LOG_SLICED.format(name="now"),
    f"""b AS (SELECT slice_key, slice_value, column_name, category, count(*) AS n FROM (
      {_values('base_sliced', _DRIFT_COLUMNS, 'slice_key, slice_value, ')}) GROUP BY ALL),
    k AS (SELECT {_WINDOW_KEYS}, column_name, category, count(*) AS n FROM (
      {_values('(SELECT *, date_trunc(' + chr(39) + 'day' + chr(39) + ', inference_timestamp) AS window_start, date_trunc(' + chr(39) + 'day' + chr(39) + ', inference_timestamp) + INTERVAL 1 DAY AS window_end FROM now_sliced)', _DRIFT_COLUMNS, _WINDOW_KEYS + ', ')}) GROUP BY ALL),
    g AS (SELECT DISTINCT {_WINDOW_KEYS}, column_name FROM k),
    u AS (SELECT {_WINDOW_KEYS}, column_name, category, b.n AS nb, 0 AS nc FROM g JOIN b USING (slice_key, slice_value, column_name)
      UNION ALL SELECT {_WINDOW_KEYS}, column_name, category, 0, n FROM k),
    m AS (SELECT {_WINDOW_KEYS}, column_name, category, sum(nb) AS nb, sum(nc) AS nc FROM u GROUP BY ALL)""",
    _drift_sql(_WINDOW_KEYS + ", column_name"),
    f"p AS (SELECT *, {_PVALUE} AS pv FROM d)",
)


@query(
    "drift_windows",
    _WINDOWED_DRIFT
    + " UNION ALL ".join(
        f"SELECT {_WINDOW_KEYS}, column_name, baseline_rows, current_rows, '{m}' AS metric, ROUND({e}, 6) AS value FROM p"
        for m, e in {"js_distance": "js", "tv_distance": "tv", "l_infinity": "linf", "chi_squared": "chi2", "chi_squared_pvalue": "pv"}.items()
    ),
)
def drift_windows(spark: SparkSession, sf: str) -> DataFrame:
    rows = drift.drift_metrics(*_two_sides(spark, sf), _DRIFT_COLUMNS, TIME, MODEL, _SLICES)
    return rounded(rows, "value")


_NUMERIC = """base AS (SELECT c_acctbal AS x FROM customer), now AS (SELECT s_acctbal AS x FROM supplier),
    e AS (SELECT quantile_disc(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM base),
    b AS (SELECT len(list_filter(q, lambda v: v < x)) AS category, count(*) AS n FROM base, e GROUP BY ALL),
    k AS (SELECT len(list_filter(q, lambda v: v < x)) AS category, count(*) AS n FROM now, e GROUP BY ALL),
    m AS (SELECT 'acctbal' AS column_name, category, COALESCE(b.n, 0) AS nb, COALESCE(k.n, 0) AS nc FROM b FULL JOIN k USING (category))"""


@query(
    "drift_numeric",
    with_sql(_NUMERIC, _drift_sql("column_name"))
    + "SELECT column_name, ROUND(js, 6) AS js_distance, ROUND(tv, 6) AS tv_distance, ROUND(linf, 6) AS l_infinity, ROUND(chi2, 6) AS chi_squared FROM d",
)
def drift_numeric(spark: SparkSession, sf: str) -> DataFrame:
    base = table(spark, sf, "customer").select(F.col("c_acctbal").alias("acctbal"))
    now = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("acctbal"))
    edges = drift.quantile_edges(base, "acctbal")
    banded = [drift.quantile_bands(side, "acctbal", edges) for side in (base, now)]
    wide = drift.drift(*banded, ["acctbal"]).select("column_name", "js_distance", "tv_distance", "l_infinity", "chi_squared")
    return rounded(wide, "js_distance", "tv_distance", "l_infinity", "chi_squared")
