"""Scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    separator: str = ";",
    header: bool = True,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Delimited text. Give a schema: without one Spark reads the whole input twice to infer types.

    A row that doesn't fit fails the job; ``mode="PERMISSIVE"`` with a ``_corrupt_record`` column in the
    schema keeps it there instead.
    """
    reader = spark.read.option("sep", separator).option("header", header).option("mode", mode)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_table(spark: SparkSession, source: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table by name, or a parquet folder by path."""
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    return df.select(*columns) if columns else df


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Inline rows with a declared schema; types are never guessed from the first rows."""
    return spark.createDataFrame(list(rows), schema)
