"""Counts, shares and rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewright.session import materialize

def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))


def means_by(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Row count and the mean of every value column, ordered by the keys."""
    means = [F.avg(v).alias(f"avg_{v}") for v in values]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"), *means).orderBy(*keys)


def class_shares(df: DataFrame, column: str) -> DataFrame:
    """Count and share per value. The total is the counts' sum, so the rows are read once and no task gathers all values."""
    counts = materialize(count_by(df, column), "counts")
    total = counts.agg(F.sum("row_count")).scalar()
    return counts.withColumn("share", F.col("row_count") / total)


def non_null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, non_null) for all columns from one pass."""
    names = list(columns or df.columns)
    one_row = df.agg(*[F.count(c).alias(c) for c in names])
    return to_rows(one_row, [], {c: F.struct(F.col(c).alias("non_null")) for c in names}, "column_name")


def to_rows(df: DataFrame, keep: Sequence[str], cells: dict[str, Column], name: str) -> DataFrame:
    """Turn columns into rows: one row per cell, its name in ``name``, its struct fields as columns."""
    entries = [F.struct(F.lit(n).alias(name), c.alias("_cell")) for n, c in cells.items()]
    exploded = df.select(*keep, F.explode(F.array(*entries)).alias("_entry"))
    return exploded.select(*keep, f"_entry.{name}", "_entry._cell.*")
