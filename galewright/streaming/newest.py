"""Streams that keep the newest row per key as state and write only what is new.

``newest_rows`` holds the newest row of each key with ``transformWithState`` and passes a row on only if it
is newer, so a micro-batch writes its own rows and never reads the table. ``newest`` and ``with_late``
resolve these rows when the table is read, in one aggregation. What resolves is the same whatever order
rows arrive in, however they fall into batches, and if a batch is delivered again or state has expired.
"""

from __future__ import annotations

import math
import sys
import time
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from galewright.operators.joins import backfill
from galewright.session import ship_package
from galewright.streaming.log import newest_per_key

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# The state operator also starts a worker on the driver, which has no files of the application.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def rank_of(values: Sequence) -> tuple:
    """A key that orders like Spark orders structs: NULL first, NaN last."""
    return tuple(
        (0,) if v is None else (2,) if isinstance(v, float) and math.isnan(v) else (1, v) for v in values
    )


class NewestRow(StatefulProcessor):
    """Keeps one key's newest row and emits it whenever it changes."""

    def __init__(self, schema: T.StructType, keys: Sequence[str], order: Sequence[str], ttl_ms: int | None):
        self.names = schema.names
        self.keys = list(keys)
        self.held_names = [n for n in schema.names if n not in self.keys]
        self.held_schema = T.StructType([schema[n] for n in self.held_names])
        self.at = [self.held_names.index(n) for n in order]
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("newest", self.held_schema, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        stored = self.held.get() if self.held.exists() else None
        best = None if stored is None else tuple(stored)
        newest = best
        for row in rows:
            values = tuple(row[n] for n in self.held_names)
            if newest is None or self._rank(values) > self._rank(newest):
                newest = values
        if newest is not best and newest is not None:
            self.held.update(newest)
            by_name = dict(zip(self.held_names, newest)) | dict(zip(self.keys, key))
            yield Row(**{n: by_name[n] for n in self.names})

    def _rank(self, values: tuple) -> tuple:
        return rank_of([values[i] for i in self.at])

    def close(self) -> None:
        pass


def newest_rows(stream: DataFrame, keys: Sequence[str], newest_by: str, ttl_ms: int | None = None) -> DataFrame:
    """The rows of a stream that are newer than what their key had before; equal times compare the other columns.

    State is one row per key, or with ``ttl_ms`` one per key seen within that time. A key that was forgotten
    is passed on again, which the reader resolves like any other row. Needs the RocksDB state store.
    """
    ship_package(stream.sparkSession)
    order = [newest_by, *[c for c in stream.columns if c not in keys and c != newest_by]]
    processor = NewestRow(stream.schema, keys, order, ttl_ms)
    return stream.groupBy(*keys).transformWithState(processor, stream.schema, "append", "processingTime" if ttl_ms else "none")


def append_newest(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], newest_by: str, ttl_ms: int | None = None
) -> None:
    """Append what is new per key to a parquet folder, exactly once per checkpoint, until the source is exhausted.

    With a time-to-live Spark goes on with empty batches that clear old state; the first of them ends the run.
    """
    spark = stream.sparkSession
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    trigger = {"processingTime": "1 second"} if ttl_ms else {"availableNow": True}
    try:
        rows = newest_rows(stream, keys, newest_by, ttl_ms)
        writer = rows.writeStream.format("parquet").outputMode("append").option("path", path)
        query = writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
        while ttl_ms and query.isActive:
            progress = query.lastProgress
            if progress and not progress["numInputRows"]:
                query.stop()
            time.sleep(0.2)
        query.awaitTermination()
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def newest(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], newest_by: str) -> DataFrame:
    """The table that the appended rows stand for: the newest row per key."""
    return newest_per_key(spark.read.schema(schema).parquet(path), keys, newest_by)


def with_late(logged: DataFrame, late: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The log with the late values of its keys; NULL is no value, and keys the log lacks are ignored."""
    return backfill(logged, late, keys, columns)
