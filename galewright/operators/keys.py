"""Surrogate keys and row numbers that do not pass all rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galewright.functions.hashing import digest
from galewright.session import materialize

# monotonically_increasing_id keeps the partition above bit 33 and the position in it below.
_POSITION_BITS = 33


def global_row_number(
    df: DataFrame, order_cols: Sequence[str], name: str = "row_num", partitions: int | None = None
) -> DataFrame:
    """1..n over a total order, equal to ``row_number() over (order by …)``.

    Range-partition on the order, sort inside the partitions, note each row's partition and position,
    and write that once. The position of a partition's first row is then the sum of the sizes of the
    partitions before it: a table with one row per partition. One shuffle, no single-task window.

    ``order_cols`` must end in a natural key, which also lets Spark split runs of equal leading
    values over several partitions. NULLs sort first.
    """
    order = [F.col(c) for c in order_cols]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = ranged.sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    stored = materialize(placed, "row-number").withColumns(
        {
            "_part": F.shiftrightunsigned("_place", _POSITION_BITS),
            "_position": F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        }
    )
    sizes = stored.groupBy("_part").agg((F.max("_position") + 1).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    # One row per range partition, so the broadcast is bounded by the partition count.
    numbered = stored.join(F.broadcast(offsets), "_part")
    return numbered.select(*df.columns, (F.col("_position") + F.col("_offset") + 1).cast("bigint").alias(name))


def row_number_by_digest(
    df: DataFrame, group: str, key: str, name: str = "rank_in_group", salt: str | int = "rank", partitions: int | None = None
) -> DataFrame:
    """row_number per group, ordered by the digest of ``key`` (then by ``key``), whatever a group's size.

    Range-partition on (group, digest, key), sort inside the partitions and write each row's place
    once. A row's number is its position among its group's rows in the partition plus the group's rows
    in earlier partitions: a table of one row per group and partition. A group that fills many
    partitions is cut between them like any other run of rows.
    """
    order = [F.col(group), F.col("_digest"), F.col(key)]
    marked = df.withColumn("_digest", digest(key, salt=salt))
    ranged = marked.repartitionByRange(partitions, *order) if partitions else marked.repartitionByRange(*order)
    placed = ranged.sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()).drop("_digest")
    stored = materialize(placed, "rank").withColumn("_part", F.shiftrightunsigned("_place", _POSITION_BITS))
    runs = stored.groupBy(group, "_part").agg(F.min("_place").alias("_start"), F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    offsets = runs.select(F.col(group).alias("_group"), F.col("_part").alias("_of"), (before - F.col("_start") + 1).alias("_shift"))
    same = stored[group].eqNullSafe(offsets["_group"]) & (stored["_part"] == offsets["_of"])
    return stored.join(offsets, same).select(*df.columns, (F.col("_place") + F.col("_shift")).cast("bigint").alias(name))


def row_hash(columns: Sequence[str]) -> Column:
    """md5 over the columns as text; NULL is kept apart from the empty text."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]
    return F.md5(F.concat_ws("|", *texts))


def stable_key(df: DataFrame, columns: Sequence[str], natural_key: str, name: str = "stable_key") -> DataFrame:
    """A key that depends on the row's own values only: md5 over the columns and the natural key.

    One projection. Rows that agree in all of these share the key; nothing else that is in the table, or
    is added later, changes it.
    """
    return df.select(row_hash([*columns, natural_key]).alias(name), *df.columns)
