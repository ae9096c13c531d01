"""Drift of category shares against a baseline.

Rows reduce to counts per column and category first; the distances are arithmetic on the counts.
Definitions: Jensen–Shannon distance (Lin 1991; Endres & Schindelin 2003) with log base 2, total
variation and maximum distance of the shares, Pearson's chi-squared statistic.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galewright.functions.numeric import ratio
from galewright.operators.keys import global_row_number
from galewright.operators.metrics import metric_rows
from galewright.operators.profile import windowed
from galewright.operators.project import null_as_text, slice_rows
from galewright.session import materialize, ship_package

DRIFT_METRICS = ("js_distance", "tv_distance", "l_infinity", "chi_squared", "chi_squared_pvalue")


def category_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), name: str = "n") -> DataFrame:
    """(by…, column_name, category, n). NULL counts as a category of its own."""
    cells = [
        F.struct(F.lit(c).alias("column_name"), null_as_text(F.col(c)).alias("category"))
        for c in columns
    ]
    exploded = df.select(*by, F.explode(F.array(*cells)).alias("_cell"))
    return exploded.groupBy(*by, F.col("_cell.column_name").alias("column_name"), F.col("_cell.category").alias("category")).agg(
        F.count(F.lit(1)).alias(name)
    )


def merge_on_category(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Baseline and current counts per column and category, 0 where a side lacks the category.

    A union tagged by side and one aggregation stand in for a full outer join of two aggregations.
    """
    tagged = _tag(baseline, columns, 1).unionByName(_tag(current, columns, 0))
    counts = category_counts(tagged, ["_a" + str(i) for i in range(len(columns))], ["_base"])
    named = counts.withColumn("column_name", _original(columns))
    return named.groupBy("column_name", "category").agg(
        F.sum(F.when(F.col("_base") == 1, F.col("n")).otherwise(F.lit(0))).alias("baseline_n"),
        F.sum(F.when(F.col("_base") == 0, F.col("n")).otherwise(F.lit(0))).alias("current_n"),
    )


def _tag(df: DataFrame, columns: Sequence[str], side: int) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(f"_a{i}") for i, c in enumerate(columns)], F.lit(side).alias("_base"))


def _original(columns: Sequence[str]) -> Column:
    case = F.col("column_name")
    for i, c in enumerate(columns):
        case = F.when(F.col("column_name") == f"_a{i}", F.lit(c)).otherwise(case)
    return case


def distances(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All drift metrics per group from (by…, column_name, category, baseline_n, current_n) cells.

    The group totals are joined back rather than taken by a window, so that a column with very many
    categories is not gathered in one task. An empty side gives NULL.
    """
    group = [*by, "column_name"]
    totals = cells.groupBy(*group).agg(
        F.sum("baseline_n").alias("baseline_rows"), F.sum("current_n").alias("current_rows")
    )
    shared = cells.join(totals, group)
    p = ratio(F.col("baseline_n"), F.col("baseline_rows"))
    q = ratio(F.col("current_n"), F.col("current_rows"))
    middle = (p + q) / 2
    gap = F.abs(p - q)

    def information(share: Column) -> Column:
        return F.when(share > 0, share * F.log2(share / middle)).when(share == 0, F.lit(0.0))

    both = (F.col("baseline_n") + F.col("current_n")).cast("double")
    rows = (F.col("baseline_rows") + F.col("current_rows")).cast("double")

    def surprise(seen: str, side: str) -> Column:
        expected = both * F.col(side) / rows
        return F.try_divide((F.col(seen) - expected) * (F.col(seen) - expected), expected)

    js = (F.sum(information(p)) + F.sum(information(q))) / 2
    summed = shared.groupBy(*group).agg(
        F.sqrt(F.greatest(js, F.when(js.isNotNull(), F.lit(0.0)))).alias("js_distance"),
        (F.sum(gap) / 2).alias("tv_distance"),
        F.max(gap).alias("l_infinity"),
        F.sum(surprise("baseline_n", "baseline_rows") + surprise("current_n", "current_rows")).alias("chi_squared"),
        (F.count_if(both > 0) - 1).alias("degrees_of_freedom"),
        F.any_value("baseline_rows").alias("baseline_rows"),
        F.any_value("current_rows").alias("current_rows"),
    )
    ship_package(cells.sparkSession)
    return summed.withColumn("chi_squared_pvalue", _chi_squared_tail()(F.col("chi_squared"), F.col("degrees_of_freedom")))


def chi_squared_tail(x: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(X >= x) for whole arrays: the upper regularised incomplete gamma function Q(df/2, x/2).

    Below df/2 + 1 the power series of 1 - Q, above it the continued fraction of Q (modified Lentz), each
    run for all rows at once until the last has converged, which takes about sqrt(df) steps.
    """
    x, df = np.broadcast_arrays(np.asarray(x, dtype=float), np.asarray(df, dtype=float))
    out = np.ones(x.shape)
    some = (df > 0) & (x > 0)
    a, half = df[some] / 2, x[some] / 2
    if not len(a):
        return out
    scale = np.exp(a * np.log(half) - half - np.array([math.lgamma(v) for v in a]))
    series = half < a + 1
    found = np.empty(len(a))
    found[series] = 1 - scale[series] * _gamma_series(a[series], half[series])
    found[~series] = scale[~series] * _gamma_fraction(a[~series], half[~series])
    out[some] = np.clip(found, 0.0, 1.0)
    return out


def _gamma_series(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    term = 1 / a
    total, step = term.copy(), a.copy()
    while len(a) and (np.abs(term) > 1e-16 * np.abs(total)).any():
        step += 1
        term = term * x / step
        total += term
    return total


def _gamma_fraction(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    tiny = 1e-300
    b = x + 1 - a
    c, d = np.full(len(a), 1 / tiny), 1 / np.where(np.abs(b) < tiny, tiny, b)
    value, change, i = d.copy(), np.zeros(len(a)), 0
    while len(a) and (np.abs(change - 1) > 1e-15).any() and i < 1_000_000:
        i += 1
        part = -i * (i - a)
        b = b + 2
        d = part * d + b
        c = b + part / c
        c, d = np.where(np.abs(c) < tiny, tiny, c), 1 / np.where(np.abs(d) < tiny, tiny, d)
        change = d * c
        value = value * change
    return value


def _chi_squared_tail():
    """Over the drift table only, which has one row per group and column."""

    @F.pandas_udf("double")
    def tail(x: pd.Series, df: pd.Series) -> pd.Series:
        known = (x.notna() & df.notna()).to_numpy()
        out = np.full(len(x), np.nan)
        out[known] = chi_squared_tail(x[known], df[known])
        return pd.Series(out)

    return tail


def drift(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drift of each column between two whole frames."""
    return distances(merge_on_category(baseline, current, columns))


def ranked_shares(counts: DataFrame, by: Sequence[str], name: str = "baseline_n") -> DataFrame:
    """Add to counts per (by…, category) the group's total and the category's ``rank``, 1 for the largest.

    Ranks come from one range-partitioned row number over all groups, so a column with very many categories
    is not sorted in one task. Equal counts rank by category.
    """
    ordered = global_row_number(counts.withColumn("_falling", -F.col(name)), [*by, "_falling", "category"], "_row").drop("_falling")
    totals = ordered.groupBy(*by).agg(F.sum(name).alias("baseline_rows"), F.min("_row").alias("_first"))
    joined = ordered.join(totals, list(by))
    return joined.withColumn("rank", F.col("_row") - F.col("_first") + 1).drop("_row", "_first")


def distances_of_present(cells: DataFrame, base: DataFrame, groups: Sequence[str], by: Sequence[str]) -> DataFrame:
    """All drift metrics per group from the cells of categories that the group has.

    ``cells`` has (groups…, category, current_n), ``base`` the ``ranked_shares`` per ``by``, some of the
    groups' columns. What a category contributes that only the baseline has is known in closed form: p
    to the sums of gaps and of JS terms, and to chi-squared its baseline count times current_rows / baseline_rows,
    which adds up over all such categories from what the present ones leave. The largest gap may be such
    a category's share: the largest share that the group lacks. Shares of rank r are at most 1 / r, so only
    ranks up to 1 / (largest gap of the present ones) can matter, and the first rank missing there tells it.
    """
    totals = base.groupBy(*by).agg(F.any_value("baseline_rows").alias("baseline_rows"), F.count(F.lit(1)).alias("_categories"))
    known = base.select(*by, "category", "baseline_n", "rank")
    met = cells.join(totals, list(by), "left").join(known, [*by, "category"], "left")
    met = met.fillna(0, ["baseline_n", "baseline_rows", "_categories"])
    current = cells.groupBy(*groups).agg(F.sum("current_n").alias("current_rows"))
    met = materialize(met.join(current, list(groups)), "drift-cells")
    p, q = ratio(F.col("baseline_n"), F.col("baseline_rows")), ratio(F.col("current_n"), F.col("current_rows"))
    middle, gap = (p + q) / 2, F.abs(p - q)

    def information(share: Column) -> Column:
        return F.when(share > 0, share * F.log2(share / middle)).otherwise(F.lit(0.0))

    both = (F.col("baseline_n") + F.col("current_n")).cast("double")
    rows = (F.col("baseline_rows") + F.col("current_rows")).cast("double")

    def surprise(seen: str, side: str) -> Column:
        expected = both * F.col(side) / rows
        return F.try_divide((F.col(seen) - expected) * (F.col(seen) - expected), expected)

    summed = met.groupBy(*groups, "baseline_rows", "current_rows", "_categories").agg(
        F.sum("baseline_n").alias("_met"),
        F.count_if(F.col("baseline_n") > 0).alias("_common"),
        F.count(F.lit(1)).alias("_present"),
        F.sum(information(p) + information(q)).alias("_information"),
        F.sum(gap).alias("_gaps"),
        F.max(gap).alias("_largest"),
        F.sum(surprise("baseline_n", "baseline_rows") + surprise("current_n", "current_rows")).alias("_surprise"),
    )
    summed = materialize(summed, "drift-sums")
    absent = (F.col("baseline_rows") - F.col("_met")).cast("double")
    share = ratio(absent, F.col("baseline_rows"))
    some = F.col("baseline_rows") > 0
    metrics = summed.join(_largest_absent(met, summed, base, groups, by), list(groups), "left")
    metrics = metrics.select(
        *groups,
        F.when(some, F.sqrt(F.greatest((F.col("_information") + share) / 2, F.lit(0.0)))).alias("js_distance"),
        ((F.col("_gaps") + share) / 2).alias("tv_distance"),
        F.when(some, F.greatest("_largest", F.coalesce("_absent", F.lit(0.0)))).alias("l_infinity"),
        (F.col("_surprise") + share * F.col("current_rows")).alias("chi_squared"),
        (F.col("_present") + F.col("_categories") - F.col("_common") - 1).alias("degrees_of_freedom"),
        "baseline_rows",
        "current_rows",
    )
    ship_package(cells.sparkSession)
    return metrics.withColumn("chi_squared_pvalue", _chi_squared_tail()(F.col("chi_squared"), F.col("degrees_of_freedom")))


def _largest_absent(met: DataFrame, summed: DataFrame, base: DataFrame, groups: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``_absent``: the largest baseline share that a group lacks, where it can exceed its largest gap."""
    near = F.col("rank") * F.col("_largest") <= 1.0
    ranks = met.filter(F.col("rank").isNotNull()).select(*groups, "rank").join(summed.select(*groups, "_largest"), list(groups)).filter(near)
    order = Window.partitionBy(*groups).orderBy("rank")
    # The run 1, 2, … of ranks that the group has ends before the first one it lacks.
    runs = ranks.withColumn("_run", F.col("rank") == F.row_number().over(order)).groupBy(*groups).agg(F.count_if("_run").alias("_has"))
    first = summed.select(*groups).join(runs, list(groups), "left").withColumn("rank", F.coalesce("_has", F.lit(0)) + 1)
    shares = base.select(*by, "rank", ratio(F.col("baseline_n"), F.col("baseline_rows")).alias("_absent"))
    return first.join(shares, [*by, "rank"]).select(*groups, "_absent")


def drift_metrics(
    baseline: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    timestamp: str,
    model: str,
    slices: Sequence[str] = (),
    granularity: str = "1 day",
) -> DataFrame:
    """The drift table: each window, model version and slice against the same slice of the baseline.

    Baseline and log are each read once and reduced to counts, which are written; everything after that
    works on the counts. A group's cells are only the categories it has: those that only the baseline
    has count in closed form (``distances_of_present``), so nothing grows with groups times categories.
    A slice that the baseline lacks has NULL distances.
    """
    slice_keys = ["slice_key", "slice_value"]
    groups = ["window_start", "window_end", model, *slice_keys, "column_name"]
    by = [*slice_keys, "column_name"]
    base = ranked_shares(category_counts(slice_rows(baseline, slices), columns, slice_keys, "baseline_n"), by)
    timed = slice_rows(windowed(current, timestamp, granularity), slices)
    now = materialize(category_counts(timed, columns, groups[:-1], "current_n"), "drift-current")
    wide = distances_of_present(now, materialize(base, "drift-baseline"), groups, by)
    return metric_rows(wide, [*groups, "baseline_rows", "current_rows"], DRIFT_METRICS)


def quantile_edges(baseline: DataFrame, column: str, parts: int = 10) -> list:
    """The ``parts - 1`` inner quantiles of a column, exact: the values whose ranks are the shares of the
    number of values, rounded up. Ranks come from a range-partitioned row number."""
    values = baseline.select(column).where(F.col(column).isNotNull())
    ranked = global_row_number(values, [column], "_rank")
    total = ranked.count()
    if not total:
        return []
    wanted = [-(-total * i // parts) for i in range(1, parts)]
    found = {r["_rank"]: r[column] for r in ranked.filter(F.col("_rank").isin(wanted)).collect()}
    return [found[rank] for rank in wanted]


def quantile_bands(df: DataFrame, column: str, edges: Sequence) -> DataFrame:
    """Replace a numeric column by its band between the edges, so that drift applies to it."""
    band = sum((F.when(F.col(column) > F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))
    return df.withColumn(column, F.when(F.col(column).isNotNull(), band))
