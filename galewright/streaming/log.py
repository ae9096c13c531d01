"""Streams over the inference log and the feature tables.

Sinks run as ``foreachBatch`` into snapshot tables. Spark may deliver a batch twice after a failure;
each commit carries stream and batch number, and a batch that is committed already is skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galewright.functions.numeric import utc_instant, utc_wall_clock
from galewright.operators.joins import backfill
from galewright.operators.metrics import quality_columns
from galewright.sources.snapshots import SnapshotTable


def read_stream(
    spark: SparkSession, folder: str, schema: T.StructType | str, pattern: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """New parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def daily_profile(
    stream: DataFrame, timestamp: str, model: str, label: str, prediction: str, lateness: str = "1 day"
) -> DataFrame:
    """Daily row count and quality per model version. State: four counts per open day and version."""
    timed = stream.withColumn("_instant", utc_instant(timestamp)).withWatermark("_instant", lateness)
    metrics = [c.alias(n) for n, c in quality_columns(label, prediction).items()]
    grouped = timed.groupBy(F.window("_instant", "1 day").alias("_w"), model).agg(
        F.count(F.lit(1)).alias("row_count"), *metrics
    )
    return grouped.select(
        utc_wall_clock(F.col("_w.start")).alias("window_start"),
        utc_wall_clock(F.col("_w.end")).alias("window_end"),
        model,
        "row_count",
        *quality_columns(label, prediction),
    )


def run_available(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> None:
    """Process everything that has arrived, in as many batches as the source plans, then stop."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _once(table: SnapshotTable, stream_id: str, write: Callable[[DataFrame, str], None]) -> Callable[[DataFrame, int], None]:
    """Commit each batch of a stream once. The batch is kept while it is checked, merged and written."""

    def commit(batch: DataFrame, number: int) -> None:
        tag = f"{stream_id}/{number}"
        if table.has_batch(tag):
            return
        batch.persist()
        try:
            if not batch.isEmpty():
                write(batch, tag)
        finally:
            batch.unpersist()

    return commit


def upsert_sink(
    table: SnapshotTable, keys: Sequence[str], stream_id: str, newest_by: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Merge each micro-batch into a table.

    With ``newest_by`` the newest row of a key wins, within a batch and against the stored row, so
    that the result does not depend on how rows fall into batches. Without it, the last batch wins
    and a key may occur only once per batch. ``stream_id`` names the stream together with its
    checkpoint; batch numbers are unique only within it.
    """

    def write(batch: DataFrame, tag: str) -> None:
        rows = newest_per_key(batch, keys, newest_by) if newest_by else batch
        if newest_by and table.exists():
            rows = _newer_than_stored(rows, table.as_of(), keys, newest_by)
        table.upsert(rows, keys, batch=tag)

    return _once(table, stream_id, write)


def _newer_than_stored(rows: DataFrame, stored: DataFrame, keys: Sequence[str], newest_by: str) -> DataFrame:
    """Drop rows whose key already has a newer row; equal times compare the remaining columns."""
    order = [newest_by, *[c for c in rows.columns if c not in keys and c != newest_by]]
    known = stored.select(*keys, F.struct(*order).alias("_stored"))
    fresh = F.col("_stored").isNull() | (F.struct(*order) >= F.col("_stored"))
    return rows.join(known, list(keys), "left").filter(fresh).select(*rows.columns)


def newest_per_key(df: DataFrame, keys: Sequence[str], newest_by: str) -> DataFrame:
    """One row per key, the newest. An aggregation, so repeats of a hot key collapse before the shuffle."""
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in others])
    order = F.struct(newest_by, *[c for c in others if c != newest_by])
    newest = df.groupBy(*keys).agg(F.max_by(row, order).alias("_row"))
    return newest.select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns])


def backfill_sink(
    table: SnapshotTable, keys: Sequence[str], columns: Sequence[str], stream_id: str, newest_by: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Write late labels of each micro-batch into a log that exists already; unknown keys are ignored."""

    def write(batch: DataFrame, tag: str) -> None:
        late = newest_per_key(batch, keys, newest_by) if newest_by else batch
        table.overwrite(backfill(table.as_of(), late, keys, columns), "backfill", keep_schema=True, batch=tag)

    return _once(table, stream_id, write)


def append_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append all available rows to a parquet folder, exactly once per checkpoint."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
