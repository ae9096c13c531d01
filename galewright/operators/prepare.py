"""Fitted column transformations whose statistics stay inside the plan.

Each statistic is one small aggregate, used as a scalar subquery: Spark computes it first and hands
it to the main pass as a literal, so that transforming the rows needs no join and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewright.operators.keys import global_row_number
from galewright.session import materialize


def one_hot(
    df: DataFrame, column: str, categories: Sequence[str], unknown: str = "ignore", prefix: str | None = None
) -> DataFrame:
    """0/1 columns per fitted category. Unknown values give all zeros, or fail with ``unknown='error'``."""
    if unknown not in ("ignore", "error"):
        raise ValueError("unknown must be 'ignore' or 'error'")
    value = F.col(column)
    if unknown == "error":
        message = F.concat(F.lit(f"unknown category in {column}: "), F.coalesce(value, F.lit("NULL")))
        value = F.when(value.isin(*categories), value).otherwise(F.raise_error(message).cast("string"))
    name = prefix or column
    return df.withColumns({f"{name}_{c}": F.when(value == F.lit(c), F.lit(1)).otherwise(F.lit(0)) for c in categories})


def fit_categories(df: DataFrame, column: str) -> DataFrame:
    """``(category, index)``: the distinct values of a category in order, numbered from 0."""
    distinct = df.select(F.col(column).alias("category")).where(F.col(column).isNotNull()).distinct()
    numbered = global_row_number(distinct, ["category"], "index")
    return numbered.withColumn("index", F.col("index") - 1)


def index_category(df: DataFrame, column: str, fitted: DataFrame, name: str | None = None) -> DataFrame:
    """Add the index of the fitted category, NULL for unknown values: the one position of a sparse
    one-hot vector that is 1. Takes any number of categories."""
    known = fitted.select(F.col("category").alias(column), F.col("index").alias(name or f"{column}_index"))
    return df.join(known, column, "left").select(*df.columns, name or f"{column}_index")


def most_frequent(column: str, counts: str = "_n") -> Column:
    """The value with the highest count, the smallest value among ties; over (value, count) rows."""
    return F.min_by(column, F.struct((-F.col(counts)).alias("n"), F.col(column).alias("v")))


def impute(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """NULL numbers become the mean, NULL categories the most frequent value of ``fitted_on``."""
    base = df if fitted_on is None else fitted_on
    filled: dict[str, Column] = {}
    if numeric:
        means = base.agg(F.struct(*[F.avg(c).alias(c) for c in numeric]).alias("s")).scalar()
        filled |= {c: F.coalesce(F.col(c).cast("double"), means.getField(c)) for c in numeric}
    if categorical:
        cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in categorical])
        counts = base.select(F.inline(cells)).where("v IS NOT NULL").groupBy("c", "v").agg(F.count(F.lit(1)).alias("_n"))
        modes = counts.groupBy("c").agg(most_frequent("v").alias("v"))  # a row for each column given
        found = modes.agg(F.map_from_entries(F.collect_list(F.struct("c", "v"))).alias("m")).scalar()
        filled |= {c: F.coalesce(F.col(c), F.try_element_at(found, F.lit(c)).cast(base.schema[c].dataType)) for c in categorical}
    return df.withColumns(filled)


def standard_scale(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None, suffix: str = "_z") -> DataFrame:
    """(x − mean) / population standard deviation; a constant column is only centred."""
    base = df if fitted_on is None else fitted_on
    moments = [F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]
    fitted = base.agg(F.struct(*moments).alias("f")).scalar()

    def scaled(c: str) -> Column:
        spread = fitted.getField(c).getField("s")
        return (F.col(c) - fitted.getField(c).getField("m")) / F.when(spread == 0, F.lit(1.0)).otherwise(spread)

    return df.withColumns({f"{c}{suffix}": scaled(c) for c in columns})


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights per class: rows / (classes · rows of the class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("class_rows"))
    totals = counts.agg(F.struct(F.sum("class_rows").alias("n"), F.count(F.lit(1)).alias("k")).alias("t")).scalar()
    weight = totals.getField("n") / (totals.getField("k") * F.col("class_rows"))
    return counts.select(label, "class_rows", weight.alias("class_weight"))


def with_class_weight(df: DataFrame, label: str, name: str = "class_weight") -> DataFrame:
    """Attach the balanced weight to every row, by a join with one row per class.

    The weights are written first, so that Spark knows their size when it plans: a join of unknown size is
    planned as a shuffle by class, which leaves all later work on the rows to as many tasks as there are classes.
    """
    weights = materialize(class_weights(df, label).select(label, F.col("class_weight").alias(name)), "weights")
    return df.join(weights, label, "left").select(*df.columns, name)
