"""Best-fit packing of documents into sequences, with certified bin counts.

Pieces are dealt to partitions of bounded size, and each is packed by best-fit decreasing. Dual
feasible functions give a lower bound of every partition's bin count; a partition that meets its
bound is proven optimal. Partitions with a gap exchange documents (a new deal among them) and are
packed again as long as that saves sequences. At last the sequences that are at most half full, one
per partition at most, are packed together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewright.llm.frames import columns_as, crc32_of, drop_written, map_arrow, materialize
from galewright.llm.textarrays import text_slices
from galewright.llm.tokens import encoder

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def document_pieces(docs: DataFrame, tokenizer: str, capacity: int, end: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids of all whole texts (``PIECE_SCHEMA``).

    ``end`` is appended to every document; a NULL or empty text is the end id alone. Only a longer
    document is cut: its first piece takes the remainder, all others are full. One narrow pass.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, end)
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            for texts in text_slices(batch.column("text")):
                found = encode.encode(texts)
                totals = np.diff(found.first)
                n_pieces = -(-totals // capacity)
                of = np.repeat(np.arange(len(texts)), n_pieces)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                opening = totals - (n_pieces - 1) * capacity  # length of the first piece
                length = np.where(piece == 0, opening[of], capacity)
                start = np.where(piece == 0, 0, opening[of] + (piece - 1) * capacity)
                at = found.first[of] + start
                crcs = [crc32_of(found.ids[a:b]) for a, b in zip(at.tolist(), (at + length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(texts.row, len(texts)).take(pa.array(of)), pa.array(piece.astype(np.int32)),
                        pa.array(start), pa.array(length), pa.array(crcs, pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return map_arrow(columns_as(docs, doc_id=doc_id, text=text), cut, PIECE_SCHEMA)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset in it of every length. Longest first, each into the fullest bin that holds it."""
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by the room left
    some = 0  # bit r: there are bins with room r
    opened = 0
    order = np.argsort(-lengths, kind="stable")
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        fits = some >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            target = room[left].pop()
            if not room[left]:
                some ^= 1 << left
        else:
            left, target = capacity, opened
            opened += 1
        bins[i], offsets[i] = target, capacity - left
        left -= size
        if left:
            room[left].append(target)
            some |= 1 << left
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing of these lengths has fewer bins: the best of the sum bound and two families of dual
    feasible functions (Fekete and Schepers, 2001) over all their thresholds."""
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    best = -(-int(counts @ size) // capacity)
    for k in range(1, 21):  # rounding to multiples of 1 / k
        scaled = size * (k + 1)
        value = np.where(scaled % capacity == 0, size * k, (scaled // capacity) * capacity)
        best = max(best, -(-int(counts @ value) // (capacity * k)))
    # Lengths over capacity - t count as whole, those from t on as they are, smaller ones as nothing.
    upto = np.concatenate(([0], np.cumsum(counts)))
    volume = np.concatenate(([0], np.cumsum(counts * size)))
    t = np.arange(1, capacity // 2 + 1)
    whole = upto[-1] - upto[capacity - t + 1]
    middle = volume[capacity - t + 1] - volume[t]
    return max(best, int((whole + -(-middle // capacity)).max(initial=0)))


def _packed(items: DataFrame, capacity: int, per_task: int, rnd: int) -> DataFrame:
    """Deal the items anew and pack every partition; adds sequence_id, offset and the partition's gap."""
    n = max(1, -(-items.count() // per_task))
    columns = [f.name for f in items.schema.fields]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        table = pa.Table.from_batches(rows).combine_chunks()
        lengths = table.column("length").to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        gap = int(bins.max()) + 1 - lower_bound(lengths, capacity)
        base = (rnd << 52) + (TaskContext.get().partitionId() << 28)
        for name, values in (("sequence_id", bins + base), ("offset", offsets), ("gap", np.full(len(bins), gap))):
            table = table.append_column(name, pa.array(values, pa.int64()))
        yield from table.select([*columns, "sequence_id", "offset", "gap"]).to_batches()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    return materialize(
        map_arrow(items.repartition(n), pack, f"{schema}, sequence_id long, offset long, gap long"), "packed"
    )


def _sequences(packed: DataFrame) -> int:
    return packed.select("sequence_id").distinct().count()


def pack(items: DataFrame, capacity: int, per_task: int = 200_000, rounds: int = 3) -> DataFrame:
    """Items with ``sequence_id`` and ``offset``: sequences of at most ``capacity``, gapless from 0.

    ``items`` needs a bigint column ``length`` of 1 to ``capacity``; NULL or other lengths raise an
    error. All other columns are carried along, repeated rows are items of their own, an empty table
    gives an empty one. A task holds ``per_task`` items, whatever their keys, so no key can be hot.
    Packing again goes on for at most ``rounds`` rounds; that bounds effort, never rows.
    """
    clash = {"sequence_id", "offset", "gap"} & {c.lower() for c in items.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are the result's own")
    fits = F.coalesce((F.col("length") >= 1) & (F.col("length") <= capacity), F.lit(False))
    items = items.withColumn("length", F.when(fits, F.col("length").cast("long")).otherwise(
        F.raise_error(F.concat(F.lit(f"length outside 1..{capacity}: "), F.coalesce(F.col("length").cast("string"), F.lit("NULL"))))
    ))
    items = materialize(items, "items")
    names = items.columns
    packed = _packed(items, capacity, per_task, 0)
    drop_written(items)
    for rnd in range(1, rounds + 1):
        loose = packed.where("gap > 0")
        before = _sequences(loose)
        if not before:
            break
        again = _packed(loose.select(*names), capacity, per_task, rnd)
        if _sequences(again) >= before:
            drop_written(again)
            break
        merged = materialize(packed.where("gap = 0").unionByName(again), "packed")
        drop_written(packed, again)
        packed = merged
    open_ = packed.groupBy("sequence_id").agg(F.sum("length").alias("filled")).where(F.col("filled") * 2 <= capacity)
    tail = materialize(packed.join(open_.select("sequence_id"), "sequence_id", "left_semi"), "tail")
    before = _sequences(tail)
    if before > 1:
        again = _packed(tail.select(*names), capacity, per_task, rounds + 1)
        if _sequences(again) < before:
            kept = packed.join(tail.select("sequence_id").distinct(), "sequence_id", "left_anti")
            packed = kept.select(*packed.columns).unionByName(again)
    return packed.drop("gap")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    return pack(document_pieces(docs, tokenizer, capacity), capacity)
