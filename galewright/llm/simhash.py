"""SimHash near-duplicates by the generalised pigeonhole principle.

Qin and others, "GPH: similarity search in Hamming space" (2018): split the 64 bits into m groups and
give group i a threshold t_i with sum(t_i) = radius - m + 1. Two fingerprints within the radius then
agree in some group but for t_i bits. Correlated bits share a group, and a dynamic programme chooses
the thresholds with the fewest candidates, estimated from all fingerprints' bit statistics.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewright.llm.buckets import dealt, pairs_within, whole_buckets
from galewright.llm.components import components
from galewright.llm.frames import columns_as, drop_written, map_arrow, materialize
from galewright.llm.textarrays import Texts, lower_ascii, text_slices, words

BITS = 64


def fingerprints_of(texts: Texts, width: int = 3, seed: int = 42) -> np.ndarray:
    """The fingerprint of every text: bit b is set if over half of its shingles' XXH64 have it set.

    Shingles are ``width`` words (A-Z in lower case) joined by a space, repeats included; a text of
    fewer words is one shingle, and one without words has the fingerprint 0.
    """
    data = lower_ascii(texts.data)
    found = words(texts)
    out = np.zeros(len(texts), dtype=np.uint64)
    if not len(found.start):
        return out
    # One space between words: keep the words and the first separator after each.
    keep = np.zeros(len(data) + 1, dtype=bool)
    keep[found.start] = True
    keep[found.end] ^= True
    keep = np.logical_xor.accumulate(keep)[:-1]
    after = found.end[found.end < len(data)]
    data = data.copy()
    gap = after[~keep[after]]
    data[gap] = 0x20
    keep[gap] = True
    place = np.cumsum(keep) - 1
    joined = data[keep].tobytes()
    start, end = place[found.start], place[found.end - 1] + 1
    counts = found.counts()
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.concatenate(([0], np.cumsum(n)))
    at = np.arange(first[-1]) + np.repeat(found.first[:-1] - first[:-1], n)
    last = at + np.repeat(np.minimum(counts, width) - 1, n)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(start[at].tolist(), end[last].tolist())], dtype="<u8")
    some = np.flatnonzero(n)
    set_ = _bit_counts(hashes, first)
    out[some] = np.packbits(2 * set_[some] > n[some, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def _bit_counts(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many of ``hashes[first[i]:first[i + 1]]`` have each bit set. Eight bits at a time are added
    in the bytes of one integer, at most 255 hashes before they are taken apart."""
    n = np.diff(first)
    per_text = -(-n // 255)
    block_first = np.concatenate(([0], np.cumsum(per_text)))
    begin = np.repeat(first[:-1], per_text) + 255 * (np.arange(block_first[-1]) - np.repeat(block_first[:-1], per_text))
    counts = np.zeros((len(n), 8, 8), dtype=np.int64)  # text, byte, bit
    some = np.flatnonzero(per_text)
    for bit in range(8):
        ones = (hashes >> np.uint64(bit)) & np.uint64(0x0101010101010101)
        blocks = np.add.reduceat(ones, begin).astype("<u8").view(np.uint8).reshape(-1, 8)
        counts[some, :, bit] = np.add.reduceat(blocks, block_first[some], axis=0, dtype=np.int64)
    return counts.reshape(-1, BITS)


def fingerprints(docs: DataFrame, width: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp`` of every row; ``fp`` holds the fingerprint's 64 bits as a bigint. A narrow pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprints_of(t, width) for t in text_slices(batch.column("text"))]
            fp = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    named = columns_as(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_arrow(named, run, "doc_id long, fp long")


def bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints and how many have bits i and j both set, over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            both += bits.T @ bits
            n += len(fp)
        cell = np.append(np.arange(BITS * BITS), -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell, pa.int64()), pa.array(np.append(both.ravel(), n).astype(np.int64))], names=["cell", "n"]
        )

    total = map_arrow(distinct.select("fp"), run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    found = {r.cell: r.n for r in total.collect()}  # 4,097 rows at most
    both = np.array([found.get(c, 0) for c in range(BITS * BITS)], dtype=np.float64).reshape(BITS, BITS)
    return int(found.get(-1, 0)), both


def grouped_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """Cut the bits into m groups of about equal size, correlated bits together."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tie = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    left, out = set(range(BITS)), []
    for k in range(m):
        size = len(left) // (m - k)
        group = [max(sorted(left), key=lambda b: sum(tie[b, c] for c in left if c != b))]
        left.remove(group[0])
        while len(group) < size:
            group.append(max(sorted(left), key=lambda b: sum(tie[b, c] for c in group)))
            left.remove(group[-1])
        out.append(sorted(group))
    return out


def _close_share(q: np.ndarray, most: int) -> np.ndarray:
    """P(at most t of independent bits differ), t = 0 .. most; bit k differs with probability q[k]."""
    spread = np.zeros(most + 1)
    spread[0] = 1.0
    for x in q:
        spread[1:] = spread[1:] * (1 - x) + spread[:-1] * x
        spread[0] *= 1 - x
    return np.cumsum(spread)


def allocate(n: int, both: np.ndarray, radius: int, probe_cost: float = 4.0) -> list[tuple[list[int], int]]:
    """Bit groups and their thresholds: the cheapest of 2 to radius + 1 groups.

    Cost of a threshold: estimated candidate pairs within it, and the probes it emits. A threshold of
    -1 leaves a group unused. The dynamic programme runs over groups and the sum of thresholds.
    """
    p = np.diag(both) / max(n, 1)
    q = 2 * p * (1 - p)
    best, chosen = np.inf, []
    for m in range(2, radius + 2):
        groups = grouped_bits(n, both, m)
        costs = []
        for group in groups:
            close = _close_share(q[group], radius)
            zeros = float((1 - p[group]).sum())
            probes = np.cumsum([comb(len(group), k) * (zeros / len(group)) ** k for k in range(radius + 1)])
            costs.append([0.0, *(n * (n - 1) / 2 * close + probe_cost * n * probes)])
        # table[s] = cost and thresholds of the groups so far, whose thresholds sum to s
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for cost in costs:
            step: dict[int, tuple[float, list[int]]] = {}
            for total, (so_far, chain) in table.items():
                for t in range(-1, radius + 1):
                    new = (so_far + cost[t + 1], [*chain, t])
                    if total + t not in step or new[0] < step[total + t][0]:
                        step[total + t] = new
            table = step
        found, thresholds = table[radius - m + 1]
        if found < best:
            best, chosen = found, [(g, t) for g, t in zip(groups, thresholds) if t >= 0]
    return chosen


def _keys(distinct: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """``part, key, fp``: every group's own bits, and those bits with up to t zeros set.

    Two values that differ in d <= t bits meet in their union: each sets the bits that only the other
    has. So one bucket table serves as index and probes alike.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for part, (group, most) in enumerate(plan):
                own = np.zeros(len(fp), dtype=np.uint64)
                for place, bit in enumerate(group):
                    own |= ((fp >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
                for k in range(most + 1):
                    for flips in combinations(range(len(group)), k):
                        mask = np.uint64(sum(1 << b for b in flips))
                        fits = np.flatnonzero((own & mask) == 0)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(fits), part, dtype=np.int32)),
                                pa.array((own[fits] | mask).view(np.int64)), pa.array(fp[fits].view(np.int64)),
                            ],
                            names=["part", "key", "fp"],
                        )

    return map_arrow(distinct.select("fp"), run, "part int, key long, fp long")


def bucket_links(fp: np.ndarray, first: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect, within each bucket ``first[i]:first[i + 1]``, all fingerprints that links of
    the radius connect. Small buckets give their links, larger ones a spanning forest of them."""
    small = 16
    size = np.diff(first)
    a, b = [], []
    for i, j in pairs_within(first, np.flatnonzero(np.repeat(size <= small, size))):
        close = np.bitwise_count(fp[i] ^ fp[j]) <= radius
        a.append(fp[i[close]])
        b.append(fp[j[close]])
    for k in np.flatnonzero(size > small):
        rest = fp[first[k] : first[k + 1]]
        while len(rest):  # breadth first; whatever is reached is never compared again
            reached, rest = [rest[0]], rest[1:]
            while reached and len(rest):
                node = reached.pop()
                close = np.bitwise_count(rest ^ node) <= radius
                if close.any():
                    new = rest[close]
                    a.append(new)
                    b.append(np.full(len(new), node))
                    reached.extend(new)
                    rest = rest[~close]
    none = np.zeros(0, dtype=np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _links(keys: DataFrame, radius: int, block: int) -> DataFrame:
    """Links ``a, b`` between fingerprints of a bucket; each pair of a bucket's blocks is verified in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in whole_buckets(batches):
            a, b = bucket_links(table.column("fp").to_numpy().view(np.uint64), first, radius)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return map_arrow(dealt(keys, "fp", block), run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 3, block: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` of every row: the smallest doc_id reachable by links.

    Fingerprints of whole texts link at ``radius`` or fewer differing bits. Equal fingerprints are one
    node, so copies cost nothing beyond their first; pairs are never expanded. NULL and empty texts
    have the fingerprint 0 and link with each other. A row without doc_id takes its component's id,
    which is NULL if no member has one. Repeated rows stay rows of their own. Only the two named
    columns are read.
    """
    found = materialize(fingerprints(docs, width, doc_id, text), "fingerprints")
    classes = materialize(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    plan = allocate(*bit_statistics(classes), radius)
    keys = materialize(_keys(classes, plan), "keys")
    linked = materialize(components(_links(keys, radius, block)), "components")
    drop_written(keys)
    members = materialize(linked.join(classes, linked.node == classes.fp).select("fp", "component", "least"), "members")
    heads = materialize(members.groupBy("component").agg(F.min("least").alias("component_id")), "heads")
    of_linked = members.join(heads, "component").select("fp", "component_id")
    of_class = materialize(
        classes.join(of_linked, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id")), "of-class"
    )
    return found.join(of_class, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, width: int = 3, radius: int = 3, block: int = 2048) -> DataFrame:
    """The documents without near-duplicates: one row of each group, all columns as they are.

    It is the row with the smallest doc_id, a row without doc_id only where the group has none; ties go to
    the smallest fingerprint, then to a digest of id and text. So unrelated texts that share a doc_id both
    stay, copies without doc_id become one, and of rows equal in doc_id and text any one stays. NULL texts
    and texts without words are one group. An empty table stays empty.
    """
    row = "row_digest"
    while row in docs.columns:
        row += "_"
    marked = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    found = materialize(fingerprints(marked, width, row, "text").withColumnRenamed("doc_id", "row").distinct(), "fingerprints")
    classes = materialize(found.select("fp").distinct(), "classes")
    plan = allocate(*bit_statistics(classes), radius)
    linked = materialize(components(_links(materialize(_keys(classes, plan), "keys"), radius, block)), "components")
    group = F.coalesce("component", "fp").alias("group")
    grouped = found.join(linked, found.fp == linked.node, "left").select("row", "fp", group)
    ids = marked.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("id")).distinct()
    first = F.min(F.struct(F.col("id").isNull().alias("without"), "id", "fp", "row")).getField("row").alias(row)
    heads = grouped.join(ids, "row").groupBy("group").agg(first).select(row)
    copies = marked.groupBy(row).agg(F.count("*").alias("copies"))
    heads = materialize(heads.join(copies, row), "kept")
    # The heads grow with the documents: both sides are shuffled, at every size alike, and only once.
    once, more = (heads.where(w).select(row).hint("merge") for w in ("copies = 1", "copies > 1"))
    repeated = marked.join(more, row, "left_semi").dropDuplicates([row])
    return marked.join(once, row, "left_semi").unionByName(repeated).select(*docs.columns)
