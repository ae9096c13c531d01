"""Windowed, sliced quality metrics and column profiles of an inference log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galewright.functions.templates import CustomMetric
from galewright.operators.aggregates import to_rows
from galewright.operators.metrics import averaged_columns, quality_columns
from galewright.operators.project import slice_rows

OVERALL = ":all"
WHOLE_ROW = ":table"


def windowed(df: DataFrame, timestamp: str, granularity: str = "1 day") -> DataFrame:
    """Add ``window_start`` and ``window_end`` of the tumbling window; NTZ timestamps stay NTZ."""
    w = F.window(timestamp, granularity)
    return df.withColumn("_w", w).select(*df.columns, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"))


def sliced_agg(df: DataFrame, keys: Sequence[str], slices: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """Aggregate overall and one slice at a time, never over combinations of slices.

    Each row is repeated as (slice_key, slice_value) pairs, which keeps it narrow whatever the slice
    count; the aggregation starts before the shuffle.
    """
    return slice_rows(df, slices, OVERALL).groupBy(*keys, "slice_key", "slice_value").agg(*aggregates)


def profile_metrics(
    df: DataFrame,
    timestamp: str,
    model: str,
    label: str,
    prediction: str,
    slices: Sequence[str] = (),
    columns: Sequence[str] = (),
    custom: Sequence[CustomMetric] = (),
    granularity: str = "1 day",
    classes: Sequence = (0, 1),
) -> DataFrame:
    """The profile table: one row per window, model version, slice, column and metric.

    Quality and custom metrics belong to the pseudo column ``:table``; each name in ``columns`` adds
    its count, NULL count and, for numbers, min, max, mean and standard deviation. One aggregation
    computes everything. Weighted and macro metrics run over ``classes``; accuracy and the metrics of
    class 1 belong to 0/1 labels.
    """
    cells: dict[tuple[str, str], Column] = {(WHOLE_ROW, "count"): F.count(F.lit(1))}
    cells |= {(WHOLE_ROW, n): c for n, c in quality_columns(label, prediction).items()}
    cells |= {(WHOLE_ROW, n): c for n, c in averaged_columns(label, prediction, classes).items()}
    for metric in custom:
        for source, aggregate in metric.columns(prediction, label):
            cells[source, metric.name] = aggregate
    for name in columns:
        cells |= {(name, m): c for m, c in _column_cells(df, name).items()}
    aliased = {key: f"_m{i}" for i, key in enumerate(cells)}
    aggregates = [c.cast("double").alias(aliased[key]) for key, c in cells.items()]
    keys = ["window_start", "window_end", model]
    wide = sliced_agg(windowed(df, timestamp, granularity), keys, slices, aggregates)
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.lit(m).alias("metric"), F.col(a).alias("value"))
            for (c, m), a in aliased.items()
        ]
    )
    return wide.select(*keys, "slice_key", "slice_value", F.inline(rows))


def _column_cells(df: DataFrame, name: str) -> dict[str, Column]:
    c = F.col(name)
    cells = {"non_null": F.count(c), "num_nulls": F.count_if(c.isNull())}
    if isinstance(df.schema[name].dataType, T.NumericType):
        x = c.cast("double")
        cells |= {"min": F.min(x), "max": F.max(x), "mean": F.avg(x), "stddev": F.stddev(x)}
    return cells


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, exact_distinct: bool = False) -> DataFrame:
    """Per column: rows, NULLs, distinct values and, for numbers, min, max, mean and standard deviation.

    One pass. The distinct count is a fixed-size sketch per column; ``exact_distinct`` counts the
    distinct (column, value) pairs in a second aggregation instead, which shuffles each such pair once.
    """
    names = list(columns or df.columns)
    fields = ("row_count", "num_nulls", "distinct_count", "min_value", "max_value", "mean_value", "stddev_value")
    aggregates: list[Column] = []
    for i, name in enumerate(names):
        c = F.col(name)
        is_number = isinstance(df.schema[name].dataType, T.NumericType)
        x = c.cast("double") if is_number else F.lit(None).cast("double")
        distinct = F.lit(0).cast("bigint") if exact_distinct else F.approx_count_distinct(c)
        values = (F.count(F.lit(1)), F.count_if(c.isNull()), distinct, F.min(x), F.max(x), F.avg(x), F.stddev(x))
        aggregates += [v.alias(f"_{i}_{f}") for f, v in zip(fields, values)]
    wide = df.agg(*aggregates)
    cells = {n: F.struct(*[F.col(f"_{i}_{f}").alias(f) for f in fields]) for i, n in enumerate(names)}
    found = to_rows(wide, [], cells, "column_name")
    if not exact_distinct:
        return found
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).cast("string").alias("_value")) for n in names])
    stacked = df.select(F.inline(pairs)).where("_value IS NOT NULL").groupBy("column_name", "_value").agg(F.lit(1).alias("_one"))
    counted = stacked.groupBy("column_name").agg(F.count("_one").alias("_distinct"))
    joined = found.join(counted, "column_name", "left")
    return joined.withColumn("distinct_count", F.coalesce("_distinct", F.lit(0))).drop("_distinct")


def daily_sketches(
    df: DataFrame, timestamp: str, model: str, columns: Sequence[str], slices: Sequence[str] = (), size: int = 16, granularity: str = "1 day"
) -> DataFrame:
    """``(window_start, window_end, model, slice_key, slice_value, column_name, values)``: theta sketches of the values met.

    One pass over the log; kept, they give distinct counts of any span of windows (``merged_distinct``). A
    sketch holds at most 2^size values, up to which its count is exact; beyond, the relative standard
    error is 1 / sqrt(2^size), a quarter of a per cent at 2^17.
    """
    keys = ["window_start", "window_end", model]
    sketches = [F.theta_sketch_agg(F.col(c).cast("string"), size).alias(f"_s{i}") for i, c in enumerate(columns)]
    wide = sliced_agg(windowed(df, timestamp, granularity), keys, slices, sketches)
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_s{i}").alias("values")) for i, c in enumerate(columns)])
    return wide.select(*keys, "slice_key", "slice_value", F.inline(cells))


def merged_distinct(sketches: DataFrame, by: Sequence[str], size: int = 16) -> DataFrame:
    """``(by…, column_name, distinct_count)`` over all windows in ``sketches``, without reading the log again."""
    united = sketches.groupBy(*by, "column_name").agg(F.theta_union_agg("values", size).alias("_all"))
    return united.select(*by, "column_name", F.theta_sketch_estimate("_all").alias("distinct_count"))
