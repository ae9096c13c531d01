"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from galewright.llm.textarrays import SLICE_BYTES, Texts, text_slices
from galewright.session import drop_written, fresh_path, materialize, ship_package  # noqa: F401  (re-exported)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns_as(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns under the operator's own names; other columns can't clash with its own."""
    return df.select(*(F.col(f"`{old}`").alias(new) for new, old in names.items()))


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with this package on the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; -1 without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % by, F.lit(-1)).cast("int")


def parts(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc32_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").data) & 0xFFFFFFFF


def bounded_sample(df: DataFrame, key: Column, rows: int, per: Column | None = None) -> DataFrame:
    """About ``rows`` rows (of each value of ``per``) with the smallest digests of ``key``; all if there are fewer.

    The digest's threshold follows from a count, so rows are chosen where they stand.
    """
    group = F.lit(0) if per is None else per
    marked = df.withColumn("_group", group).withColumn("_digest", F.xxhash64(key.cast("string"), F.lit("sample")))
    counts = {r["_group"]: r["count"] for r in marked.groupBy("_group").count().collect()}
    if not counts:
        return marked.drop("_group", "_digest")
    share = F.coalesce(*(F.when(F.col("_group") == g, F.lit(min(1.0, rows / n))) for g, n in counts.items()))
    low = F.col("_digest") / F.lit(2.0**64) + 0.5
    return marked.where(low < share).drop("_group", "_digest")


def filter_texts(docs: DataFrame, keep: Callable[[Texts], np.ndarray], text: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The rows whose texts ``keep`` accepts, all columns as they are. One narrow pass, no join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [keep(texts) for texts in text_slices(batch.column(at), slice_bytes)]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    at = docs.columns.index(text)
    return map_arrow(docs, run, docs.schema)
