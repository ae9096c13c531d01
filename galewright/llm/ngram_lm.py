"""Language-model scores by deleted interpolation (Jelinek and Mercer, 1980).

The probability of a token mixes maximum-likelihood estimates of falling order,

    p(w | h) = l(c(h)) * c(h w) / c(h) + (1 - l(c(h))) * p(w | h without its first token),

down to the token's own share and a uniform share of 1 / (V + 1). Each order's weight depends on the
bucket of its context's count. The weights are learned by expectation-maximisation on a held-out part
of the training texts, whose own counts are deleted for that; scores then use all training counts.

Counts are gathered by a request and its reply. Texts are kept in batches; a batch sends each of its
distinct n-grams once, as a sorted run of hashes (64 bits for tokens, 56 for longer n-grams) with its
count, to the bin that holds the hash. A bin adds up what all batches sent and answers each with the totals in the same order, so an
answer holds no keys. A frequent n-gram is one entry per batch, and no task holds more than one bin or
one batch. Requests are at most batches times bins, and never more than the batches' distinct n-grams.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewright.llm.frames import columns_as, map_arrow, materialize, parts, ship_package
from galewright.llm.textarrays import Texts, add_up, joined, lower_ascii, sums, text_slices, word_hashes, words

FIT, TUNE, SCORE = range(3)  # roles: counted; counted, and deleted to learn the weights; only scored

_END = np.uint64(0x6C62272E07BB0142)
_START = np.uint64(0x27D4EB2F165667C5)
_SHORTER = np.uint64(8)  # keys of longer n-grams have 56 bits
_STEPS = 4  # probabilities are binned by quarters of a power of two
_ZERO = 127


@dataclass(frozen=True)
class ModelSettings:
    order: int = 2
    batch_bytes: int = 6_000_000
    bins_per_part: int = 2
    rounds: int = 60


def grams(texts: Texts, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the n-grams of each order that end at each token, and every text's first token.

    Tokens are the words (A-Z in lower case) and one end per text. N-grams reach back to one start
    symbol before the text.
    """
    found = words(texts)
    own = word_hashes(lower_ascii(texts.data), found)
    n = len(texts)
    first = found.first + np.arange(n + 1)
    token = np.full(first[-1], _END, dtype=np.uint64)
    token[np.arange(len(own)) + found.text_of()] = own
    out = [token]
    for _ in range(1, order):
        before = np.empty_like(token)
        before[1:] = out[-1][:-1]
        before[first[:-1]] = _START
        out.append(joined(before, token))
    return out, first


def _together(slices: list[tuple[list[np.ndarray], np.ndarray]], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    counts = np.concatenate([np.diff(first) for _, first in slices])
    return [np.concatenate([g[k] for g, _ in slices]) for k in range(order)], np.concatenate(([0], np.cumsum(counts)))


def _packed(values: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs, compressed."""
    width = next(w for w in (1, 2, 4, 8) if not len(values) or int(values.max()) < 1 << (8 * w - 1))
    return bytes([width]) + zstandard.compress(np.ascontiguousarray(values, dtype=f"<i{width}").tobytes(), 1)


def _unpacked(blob: bytes) -> np.ndarray:
    values = np.frombuffer(zstandard.decompress(blob[1:]), dtype=f"<i{blob[0]}")
    return values.astype(np.int64 if blob[0] == 8 else np.int32)


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys: the first, then their steps in as few bytes each as the largest needs."""
    steps = np.diff(keys)
    width = max(1, -(-int(steps.max()).bit_length() // 8)) if len(steps) else 1
    narrow = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])
    return bytes([width]) + keys[:1].astype("<u8").tobytes() + narrow.tobytes()


def unpack_keys(blob: bytes) -> np.ndarray:
    width = blob[0]
    narrow = np.frombuffer(blob, dtype=np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(narrow), 8), dtype=np.uint8)
    steps[:, :width] = narrow
    out = np.empty(len(narrow) + 1, dtype=np.uint64)
    out[0] = np.frombuffer(blob, dtype="<u8", count=1, offset=1)[0]
    out[1:] = steps.view("<u8")[:, 0]
    return np.cumsum(out, dtype=np.uint64)


def _batches(docs: DataFrame, settings: ModelSettings) -> DataFrame:
    """Texts of one role each in batches of about ``batch_bytes``, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[int | None, bytes]]] = {FIT: [], TUNE: [], SCORE: []}
        size = dict.fromkeys(waiting, 0)
        base, made = TaskContext.get().partitionId() << 24, 0

        def flush(role: int) -> pa.RecordBatch:
            ids, texts = zip(*waiting[role])
            waiting[role], size[role] = [], 0
            columns = [
                pa.array([base + made], pa.int64()), pa.array([role], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([zstandard.compress(b"".join(texts), 3)], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["batch", "role", "ids", "lengths", "content"])

        for batch in batches:
            for doc_id, text, role in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "role"))):
                raw = (text or "").encode()
                waiting[role].append((doc_id, raw))
                size[role] += len(raw) + 1
                if size[role] >= settings.batch_bytes:
                    yield flush(role)
                    made += 1
        for role in waiting:
            if waiting[role]:
                yield flush(role)
                made += 1

    return map_arrow(docs, run, "batch long, role int, ids array<long>, lengths array<long>, content binary")


def _grams_of(content: bytes, lengths: list[int], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    data = np.frombuffer(zstandard.decompress(content) if content else b"", dtype=np.uint8)
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    found, first = _together([grams(texts, order) for texts in text_slices(column)], order)
    for longer in found[1:]:
        longer >>= _SHORTER
    return found, first


def _requests(kept: DataFrame, settings: ModelSettings, bits: int) -> DataFrame:
    """``bin, level, batch, role, keys, counts``: every batch's distinct n-grams, by the hash's top bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches:
            for row in table.to_pylist():
                hashes, _ = _grams_of(row["content"], row["lengths"], settings.order)
                for level, found in enumerate(hashes):
                    keys, counts = np.unique(found, return_counts=True)
                    bins = (keys >> np.uint64((56 if level else 64) - bits)).astype(np.int64)
                    begin = np.flatnonzero(np.diff(bins, prepend=-1))
                    stop = np.append(begin[1:], len(bins))
                    n = len(begin)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(bins[begin].astype(np.int32)), pa.array(np.full(n, level, dtype=np.int32)),
                            pa.array(np.full(n, row["batch"])), pa.array(np.full(n, row["role"], dtype=np.int32)),
                            pa.array([pack_keys(keys[a:b]) for a, b in zip(begin, stop)], pa.binary()),
                            pa.array([_packed(counts[a:b]) for a, b in zip(begin, stop)], pa.binary()),
                        ],
                        names=["bin", "level", "batch", "role", "keys", "counts"],
                    )

    return map_arrow(
        kept.select("batch", "role", "lengths", "content"), run, "bin int, level int, batch long, role int, keys binary, counts binary"
    )


def _replies(requests: DataFrame, n_parts: int) -> DataFrame:
    """``level, bin, batch, role, counted, deleted``: training counts in the order asked, and for batches
    that tune also those without the tuning texts. Rows with batch -1 hold a bin's totals over all
    tokens: numbers of different ones, of all, and of all but the tuning texts'."""
    dealt = requests.repartition(n_parts, "bin", "level").sortWithinPartitions("bin", "level")

    def answer(rows: list[dict]) -> pa.RecordBatch:
        keys = [unpack_keys(r["keys"]) for r in rows]
        counts = [_unpacked(r["counts"]) for r in rows]
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        bounds = np.cumsum([0, *map(len, keys)])
        all_, tuned = (np.zeros(place.max() + 1, dtype=np.int64) for _ in range(2))
        for r, n, a, b in zip(rows, counts, bounds[:-1], bounds[1:]):
            if r["role"] != SCORE:
                all_[place[a:b]] += n  # the keys of one request differ
            if r["role"] == TUNE:
                tuned[place[a:b]] += n
        spans = [place[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        counted = [_packed(all_[s]) for s in spans]
        deleted = [_packed((all_ - tuned)[s]) if r["role"] == TUNE else None for r, s in zip(rows, spans)]
        level, bin_ = rows[0]["level"], rows[0]["bin"]
        totals = _packed(np.array([(all_ > 0).sum(), all_.sum(), all_.sum() - tuned.sum()]))
        n = len(rows) + 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array([level] * n, pa.int32()), pa.array([bin_] * n, pa.int32()),
                pa.array([*(r["batch"] for r in rows), -1], pa.int64()), pa.array([*(r["role"] for r in rows), -1], pa.int32()),
                pa.array([*counted, totals], pa.binary()), pa.array([*deleted, None], pa.binary()),
            ],
            names=["level", "bin", "batch", "role", "counted", "deleted"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if waiting and (row["bin"], row["level"]) != (waiting[0]["bin"], waiting[0]["level"]):
                    yield answer(waiting)
                    waiting = []
                waiting.append(row)
        if waiting:
            yield answer(waiting)

    return map_arrow(dealt, run, "level int, bin int, batch long, role int, counted binary, deleted binary")


@dataclass
class Estimates:
    """For every token of a batch: counts by level, context counts by level, and the texts' bounds."""

    counts: list[np.ndarray]
    contexts: list[np.ndarray]
    first: np.ndarray


def _estimates(row: dict, replies: pa.Table, column: str, settings: ModelSettings) -> Estimates:
    hashes, first = _grams_of(row["content"], row["lengths"], settings.order)
    replies = replies.sort_by([("level", "ascending"), ("bin", "ascending")])
    levels, blobs = replies.column("level").to_pylist(), replies.column(column).to_pylist()
    counts, contexts = [], []
    for level in range(len(hashes)):
        found, hashes[level] = hashes[level], None
        answer = np.concatenate([_unpacked(b) for k, b in zip(levels, blobs) if k == level])
        keys, place = np.unique(found, return_inverse=True)
        if level == 0:
            texts = answer[np.searchsorted(keys, _END)]  # every counted text has one end
        else:
            context = np.empty(len(found), dtype=np.result_type(counts[-1], texts))
            context[1:] = counts[-1][:-1]
            context[first[:-1]] = texts
            contexts.append(context)
        counts.append(answer[place])
    return Estimates(counts, contexts, first)


def context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the whole part of the count's binary logarithm."""
    return np.where(count > 0, np.log2(np.maximum(count, 1)).astype(np.int64) + 1, 0)


def _shares(found: Estimates, total: int) -> list[np.ndarray]:
    """Maximum-likelihood estimates by level."""
    out = [found.counts[0] / max(total, 1)]
    for count, context in zip(found.counts[1:], found.contexts):
        out.append(np.where(context > 0, count / np.maximum(context, 1), 0.0))
    return out


def _expected(cells: np.ndarray, numbers: np.ndarray, weights: list[np.ndarray], types: int) -> np.ndarray:
    """By level and context bucket: cells, tokens that reach the level, and tokens that it explains."""
    shares, buckets = [], []
    for _ in weights:
        step = cells & 127
        shares.append(np.where(step == _ZERO, 0.0, 2.0 ** (-step / _STEPS)))
        buckets.append((cells >> 7) & 63)
        cells = cells >> 13
    below, levels = np.full(len(numbers), 1 / (types + 1)), []
    for weight, share, bucket in zip(weights, shares, buckets):
        part = weight[bucket] * share
        below = part + (1 - weight[bucket]) * below
        levels.append(part / below)
    left, out = numbers.astype(np.float64), np.zeros((len(weights), 3, 64))
    for k in reversed(range(len(weights))):
        for row, v in enumerate((None, left, left * levels[k])):
            out[k, row] = np.bincount(buckets[k], weights=v, minlength=64)
        left = left * (1 - levels[k])
    return out


def _maximised(expected: Callable[[list[np.ndarray]], np.ndarray], order: int, rounds: int) -> list[np.ndarray]:
    weights, met = [np.full(64, 0.5) for _ in range(order)], np.zeros((order, 64), dtype=bool)
    for _ in range(rounds):
        found = expected(weights)
        met = found[:, 0] > 0
        weights = [np.where(f[1] > 0, f[2] / np.maximum(f[1], 1e-300), w) for f, w in zip(found, weights)]
    for k in range(order):
        for b in range(1, 64):  # a bucket without held-out tokens takes the next lower one's weight
            if not met[k, b]:
                weights[k][b] = weights[k][b - 1]
        if k:
            weights[k][0] = 0.0
        weights[k] = np.clip(weights[k], 0.0, 1 - 1e-6)  # the rest never vanishes
    return weights


def learn_weights(cells: np.ndarray, numbers: np.ndarray, order: int, types: int, rounds: int) -> list[np.ndarray]:
    """Weights by level and context bucket from held-out tokens counted by cell (``_cells``)."""
    return _maximised(lambda w: _expected(cells, numbers, w, types), order, rounds if len(numbers) else 0)


def learn_weights_where_they_stand(cells: DataFrame, order: int, types: int, rounds: int) -> list[np.ndarray]:
    """The same from a written table ``cell, n``: every round, the tasks send sums of a fixed size."""

    def expected(weights: list[np.ndarray]) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((order, 3, 64))
            for batch in batches:
                total += _expected(batch.column("cell").to_numpy(), batch.column("n").to_numpy(), weights, types)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["sums"])

        return sum((np.frombuffer(r.sums).reshape(order, 3, 64) for r in map_arrow(cells, run, "sums binary").collect()), np.zeros((order, 3, 64)))

    return _maximised(expected, order, rounds)


def _cells(found: Estimates, total: int) -> np.ndarray:
    """Each token's shares, in quarters of a power of two, and context buckets as one integer."""
    out = np.zeros(len(found.counts[0]), dtype=np.int64)
    buckets = [np.zeros_like(out), *map(context_bucket, found.contexts)]
    for share, bucket in reversed(list(zip(_shares(found, total), buckets))):
        step = np.where(share > 0, np.clip(np.round(-_STEPS * np.log2(np.maximum(share, 1e-300))), 0, _ZERO - 1), _ZERO)
        out = (out << 13) | (bucket << 7) | step.astype(np.int64)
    return out


def score(docs: DataFrame, role: Column, settings: ModelSettings = ModelSettings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``role`` says of each row whether it is counted (FIT), counted and held out to learn the weights
    (TUNE) or only scored (SCORE); a NULL role scores only. ``score`` is the mixture's log10 probability
    of the whole text with its end; ``base_score`` the add-one score of its tokens. A NULL or empty text
    is its end alone. Equal texts score equally, repeated rows count repeatedly. Without training texts
    every token has the uniform share. Only the role's columns and the two named ones are read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    n_parts = parts(spark)
    bits = max(1, (n_parts * settings.bins_per_part - 1).bit_length())
    named = columns_as(docs.withColumn("_role", F.coalesce(role, F.lit(SCORE)).cast("int")), doc_id=doc_id, text=text, role="_role")
    kept = materialize(_batches(named.withColumn("doc_id", F.col("doc_id").cast("long")), settings), "texts")
    replies = materialize(_replies(_requests(kept, settings, bits), n_parts), "counts")
    totals = replies.where("batch = -1 AND level = 0").select("counted")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum((_unpacked(b) for batch in batches for b in batch.column(0).to_pylist()), np.zeros(3, dtype=np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([int(v)]) for v in total], names=["types", "tokens", "untuned"])

    found = map_arrow(totals, add, "types long, tokens long, untuned long").agg(*(F.sum(c).alias(c) for c in ("types", "tokens", "untuned"))).first()
    types, tokens, untuned = (int(v or 0) for v in found)

    def tally(left: pa.Table, right: pa.Table) -> pa.Table:
        seen = [_cells(_estimates(row, right, "deleted", settings), untuned) for row in left.to_pylist()]
        cells, numbers = np.unique(np.concatenate(seen or [np.zeros(0, np.int64)]), return_counts=True)
        return pa.table({"cell": cells, "n": numbers})

    def by_batch(which: str) -> tuple:
        return kept.where(which).groupBy("batch"), replies.where(which).where("batch >= 0").groupBy("batch")

    texts, answers = by_batch(f"role = {TUNE}")
    held_out = texts.cogroup(answers).applyInArrow(tally, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    held_out = materialize(held_out, "cells")
    rounds = 0 if held_out.isEmpty() else settings.rounds
    weights = learn_weights_where_they_stand(held_out, settings.order, types, rounds)
    if not tokens:
        weights = [np.zeros(64) for _ in weights]

    def rate(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            est = _estimates(row, right, "counted", settings)
            p = np.full(len(est.counts[0]), 1 / (types + 1))
            buckets = [np.zeros(len(p), dtype=np.int64), *map(context_bucket, est.contexts)]
            for weight, share, bucket in zip(weights, _shares(est, tokens), buckets):
                p = weight[bucket] * share + (1 - weight[bucket]) * p
            base = np.log10((est.counts[0] + 1) / (tokens + types + 1))
            n = len(row["ids"])
            out.append(pa.table({
                "doc_id": pa.array(row["ids"], pa.int64()), "n_tokens": np.diff(est.first), "n_known": sums(est.counts[0] > 0, est.first),
                "train_tokens": np.full(n, tokens), "base_score": add_up(base, est.first), "score": add_up(np.log10(p), est.first),
            }))
        return pa.concat_tables(out)

    texts, answers = by_batch(f"role IN ({FIT}, {TUNE}, {SCORE})")
    return texts.cogroup(answers).applyInArrow(
        rate, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
