"""Buckets of candidates, dealt to tasks so that none holds more than two blocks of a bucket."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewright.llm.frames import materialize, parts

NAMES = ("part", "key", "i", "j")


def dealt(rows: DataFrame, member: str, block: int) -> DataFrame:
    """``rows`` (columns part, key, ``member`` and others) with each bucket's rows together and in order.

    A bucket of over ``block`` rows is cut into blocks by the member's hash, and each pair of blocks
    (``i <= j``) becomes a bucket of its own. ``own`` is a row's block: in a bucket with ``i < j`` only
    pairs of different ``own`` are new. So no pair is lost and no task holds a whole hot bucket.
    """
    bucket = ["part", "key"]
    large = rows.groupBy(*bucket).agg(F.count("*").alias("n")).where(F.col("n") > block)
    large = materialize(large.withColumn("pieces", F.ceil(F.col("n") / block).cast("int")).drop("n"), "buckets")
    cut = (
        rows.join(large, bucket, "left")
        .withColumn("pieces", F.coalesce("pieces", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64(member), F.col("pieces")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .drop("pieces", "other")
    )
    return cut.repartition(parts(rows.sparkSession), *NAMES).sortWithinPartitions(*NAMES)


def whole_buckets(batches: Iterator[pa.RecordBatch], at_least: int = 50_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows of whole buckets, with the bounds of each; for ``dealt`` rows in ``mapInArrow``."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        if rest.num_rows >= at_least:
            starts = _starts(rest)
            if len(starts) > 1:
                yield rest.slice(0, starts[-1]), starts
                rest = rest.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield rest, np.append(_starts(rest), rest.num_rows)


def _starts(table: pa.Table) -> np.ndarray:
    new = np.ones(table.num_rows, dtype=bool)
    columns = [table.column(c).to_numpy() for c in NAMES]
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def pairs_within(first: np.ndarray, start: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All index pairs ``i < j`` within each range ``first[k]:first[k + 1]``, one distance after the other."""
    end = np.repeat(first[1:], np.diff(first))
    at = np.arange(len(end)) if start is None else start
    step = 1
    while len(at):
        at = at[at + step < end[at]]
        yield at, at + step
        step += 1
