"""Token ids on disk as directly addressable codes (Brisaboa, Ladra and Navarro, 2009).

An id is cut into 8-bit chunks, least significant first. Level 0 holds the first chunk of every id
and a bit that says whether the id goes on; level 1 holds the second chunk of those that do, and so
on. The id's place in the next level is the number of set bits before it, which a rank directory
(set bits before every 512) answers in one step. So any id is read from a few bytes, and no block is
ever decoded to reach it.

A token file is one byte string: header, document directory, levels. Files are written by Spark as
rows of a Parquet dataset (columns ``part, seq, n_docs, n_ids, content``), so they go to any store
that Spark can write, whole or not at all, and the counts are read without the content. Files are in
ascending doc_id order: ``part`` first, ``seq`` within it.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from galewright.llm.frames import columns_as, crc32_of, map_arrow, parts
from galewright.llm.textarrays import text_slices
from galewright.llm.tokens import encoder

_MAGIC = b"GWDAC1\0\0"
_RANK_BITS = 512
FILE_SCHEMA = "part int, seq int, n_docs long, n_ids long, content binary"


def _level(chunks: np.ndarray, goes_on: np.ndarray) -> bytes:
    bitmap = np.packbits(goes_on, bitorder="little")
    per_block = np.add.reduceat(goes_on, np.arange(0, len(goes_on), _RANK_BITS), dtype=np.int64)
    ranks = (np.cumsum(per_block) - per_block).astype("<u8")
    return struct.pack("<Q", len(chunks)) + chunks.tobytes() + bitmap.tobytes() + ranks.tobytes()


def write_file(doc_ids: np.ndarray, has_id: np.ndarray, first: np.ndarray, ids: np.ndarray) -> bytes:
    """One token file; document k has the ids ``first[k]:first[k + 1]``, and no doc_id where ``has_id`` is False."""
    levels, left = [], ids.astype(np.uint32)
    while len(left):
        goes_on = left > 0xFF
        levels.append(_level((left & 0xFF).astype(np.uint8), goes_on))
        left = left[goes_on] >> np.uint32(8)
    head = _MAGIC + struct.pack("<QQQ", len(doc_ids), len(ids), len(levels))
    directory = doc_ids.astype("<i8").tobytes() + has_id.astype(np.uint8).tobytes() + first.astype("<i8").tobytes()
    return head + directory + b"".join(levels)


class TokenFile:
    """Random access to a token file's ids. Arrays are views of ``content``; opening copies nothing."""

    def __init__(self, content: bytes):
        if content[:8] != _MAGIC:
            raise ValueError("not a token file")
        self.n_docs, self.n_ids, n_levels = struct.unpack_from("<QQQ", content, 8)
        at = 32
        self.doc_ids, at = self._array(content, "<i8", self.n_docs, at)
        self.has_id, at = self._array(content, "?", self.n_docs, at)
        self.first, at = self._array(content, "<i8", self.n_docs + 1, at)
        self.levels = []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", content, at)
            chunks, at = self._array(content, "u1", n, at + 8)
            bitmap, at = self._array(content, "u1", -(-n // 8), at)
            ranks, at = self._array(content, "<u8", -(-n // _RANK_BITS), at)
            self.levels.append((chunks, bitmap, ranks))

    @staticmethod
    def _array(content: bytes, kind: str, n: int, at: int) -> tuple[np.ndarray, int]:
        found = np.frombuffer(content, dtype=kind, count=n, offset=at)
        return found, at + found.nbytes

    def __getitem__(self, i: int) -> int:
        """Id number ``i`` of the file."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = shift = 0
        for chunks, bitmap, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // _RANK_BITS
            before = bitmap[block * _RANK_BITS // 8 : i // 8].tobytes() + bytes([int(bitmap[i // 8]) & ((1 << (i % 8)) - 1)])
            i = int(ranks[block]) + int.from_bytes(before, "little").bit_count()
            shift += 8
        return value

    def ids(self) -> np.ndarray:
        """All ids in order."""
        values = np.zeros(self.n_ids, dtype=np.uint32)
        place = np.arange(self.n_ids)
        for k, (chunks, bitmap, _) in enumerate(self.levels):
            values[place] |= chunks.astype(np.uint32) << np.uint32(8 * k)
            place = place[np.unpackbits(bitmap, count=len(chunks), bitorder="little").view(bool)]
        return values

    def document(self, k: int) -> list[int]:
        """The ids of document number ``k``, one access each."""
        return [self[i] for i in range(int(self.first[k]), int(self.first[k + 1]))]


def token_files(
    docs: DataFrame, tokenizer: str, end: int = 0, doc_id: str = "doc_id", text: str = "text", ids_per_file: int = 1_000_000
) -> DataFrame:
    """Token files (``FILE_SCHEMA``) of all whole texts, in ascending doc_id order.

    ``end`` is appended to every document. Only the two named columns are read. A NULL or empty text
    has the end id alone. Rows without doc_id come first; rows of equal doc_id are in the order of
    their texts' hashes, all kept. A file holds whole documents: it is closed at ``ids_per_file`` ids
    or more. An empty table has no files. One shuffle, by ranges of doc_id.
    """
    named = columns_as(docs, doc_id=doc_id, text=text)
    order = (F.col("doc_id").cast("long").asc_nulls_first(), F.xxhash64("text"))
    ranged = named.repartitionByRange(parts(docs.sparkSession), *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seq = encoder(tokenizer, end), TaskContext.get().partitionId(), 0
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            doc_ids, has_id, lengths, ids = (np.concatenate(x) for x in zip(*waiting))
            content = write_file(doc_ids, has_id, np.concatenate(([0], np.cumsum(lengths))), ids)
            waiting.clear()
            row = {"part": part, "seq": seq, "n_docs": len(doc_ids), "n_ids": len(ids), "content": content}
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types)], names=list(row))

        for batch in batches:
            all_ids = batch.column("doc_id").cast(pa.int64())
            for texts in text_slices(batch.column("text")):
                found = encode.encode(texts)
                here = all_ids.slice(texts.row, len(texts))
                has_id = here.is_valid().to_numpy(zero_copy_only=False)
                waiting.append((here.fill_null(0).to_numpy(zero_copy_only=False), has_id, np.diff(found.first), found.ids))
                if sum(len(w[3]) for w in waiting) >= ids_per_file:
                    yield flush()
                    seq += 1
        if waiting:
            yield flush()

    return map_arrow(ranged, write, FILE_SCHEMA)


def save(files: DataFrame, path: str) -> None:
    """Write token files below ``path``."""
    files.write.parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def first_ids(files: DataFrame) -> DataFrame:
    """``part, seq, before``: the number of ids in all earlier files. Reads the counts, not the content.

    Sums run over the files of a part, and over one total per part.
    """
    counts = files.select("part", "seq", "n_ids")
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    starts = totals.select("part", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("of_part"))
    within = counts.withColumn("in_part", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    return within.join(starts, "part").select("part", "seq", (F.col("of_part") + F.col("in_part")).alias("before"))


def read_documents(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from its file.

    ``start`` counts the ids of all documents before it; the crc32 covers its ids as little-endian
    unsigned 32-bit integers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, content in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "content"))):
                opened = TokenFile(content)
                ids, first = opened.ids(), opened.first
                crcs = [crc32_of(ids[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                n = opened.n_docs
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, part, dtype=np.int32)), pa.array(np.full(n, seq, dtype=np.int32)),
                        pa.array(opened.doc_ids, mask=~opened.has_id), pa.array(first[:-1]),
                        pa.array(np.diff(first)), pa.array(crcs, pa.int64()),
                    ],
                    names=["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    found = map_arrow(
        files.select("part", "seq", "content"), read,
        "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long",
    )
    return found.join(first_ids(files), ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
