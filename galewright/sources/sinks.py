"""Writes to plain folders and catalog tables.

Spark refuses to replace a table that the same plan reads. A snapshot table (``snapshots.py``) writes each
version to a folder of its own, so there a plan may read what it replaces, and a failed write leaves
the old data in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galewright.session import fresh_path


class SchemaMismatch(ValueError):
    """The frame to write does not have the stored schema."""


def schema_differences(stored: T.StructType, offered: T.StructType) -> list[str]:
    """Readable differences by name and type; nullability is not compared, files are always nullable."""
    old = {f.name: f.dataType for f in stored.fields}
    new = {f.name: f.dataType for f in offered.fields}
    gone = [f"missing column {n}" for n in old if n not in new]
    added = [f"unexpected column {n}" for n in new if n not in old]
    changed = [
        f"column {n} is {new[n].simpleString()}, stored as {old[n].simpleString()}"
        for n in old
        if n in new and old[n] != new[n]
    ]
    return gone + added + changed


def append(df: DataFrame, path: str) -> None:
    """Add files to a folder whose schema must already fit."""
    require_schema(df.sparkSession.read.parquet(path).schema, df)
    df.write.mode("append").parquet(path)


def require_schema(stored: T.StructType, df: DataFrame) -> None:
    problems = schema_differences(stored, df.schema)
    if problems:
        raise SchemaMismatch("; ".join(problems))


def create_or_replace_table(
    df: DataFrame, name: str, path: str | None = None, bucket_by: Sequence[str] = (), buckets: int = 0
) -> DataFrame:
    """CREATE OR REPLACE TABLE name AS SELECT; ``path`` keeps the files outside the warehouse folder.

    Tables that are joined on a key again and again can be written bucketed and sorted by it; joins
    of two tables with equal bucketing then need no shuffle.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """All splits in one pass: a partition folder per split, read back with partition pruning."""
    df.write.mode("errorifexists").partitionBy(split_col).parquet(path)


def read_split(spark: SparkSession, path: str, split: str, split_col: str = "split") -> DataFrame:
    return spark.read.parquet(path).filter(F.col(split_col) == split).drop(split_col)


def write_or_count(df: DataFrame, dry_run: bool, path: str | None = None) -> DataFrame:
    """One row (written, rows). A dry run counts; a real run writes once and counts the written files."""
    spark = df.sparkSession
    if dry_run:
        counted = df
    else:
        target = path or fresh_path(spark, "scored")
        df.write.parquet(target)
        counted = spark.read.schema(df.schema).parquet(target)
    return counted.agg(F.count(F.lit(1)).alias("row_count")).select(
        (~F.lit(dry_run)).cast("int").alias("written"), "row_count"
    )
