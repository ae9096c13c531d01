"""Removal of passages that an earlier document has, by FM-indexes over shards of shared text.

A window is ``window`` consecutive words. Its minimizer, the five words in it with the smallest hash, is
the same wherever the window occurs, so text is cut into segments of windows with one minimizer, and
only segments whose minimizer several documents have go on. Shards are dealt by minimizer: all equal
windows meet in one shard, whatever documents they are in. A shard's distinct segments are indexed
(``fm_index.py``), and streamed through the index: where the matching statistics reach the window's
length, the suffix block tells the smallest document of all segments with that window.

Documents are held in batches dealt by hash. A batch sends each segment once, with its smallest
doc_id, so a passage that a third of all documents share costs a shard one row a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewright.llm.fm_index import FMIndex
from galewright.llm.frames import columns_as, map_arrow, parts, ship_package
from galewright.llm.textarrays import Texts, Words, range_hashes, ranges, text_slices, word_hashes, words

MINIMIZER = 5
#: Text that a batch of documents is meant to hold, in bytes; one longer document is a batch of its own.
BATCH_BYTES = 16 << 20
#: Shards to a batch: if all text were shared, a shard would hold about two fifths of a batch.
_SHARDS = 8


@dataclass(frozen=True)
class Segments:
    """Runs of windows with one minimizer: segment i covers words ``[start, end)`` of text ``text``."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    minimizer: np.ndarray


def segments_of(hashes: np.ndarray, first: np.ndarray, window: int) -> Segments:
    """The segments of texts whose word hashes are ``hashes[first[i]:first[i + 1]]``."""
    least = min(MINIMIZER, window)
    span = window - least + 1
    n = len(hashes) - window + 1
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return Segments(none, none, none, none.astype(np.uint64))
    start = np.arange(len(hashes) - least + 1)
    grams = range_hashes(hashes, start, start + least)
    smallest = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(axis=1) + np.arange(n)
    inside = text[:n] == text[window - 1 :]
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (smallest[1:] != smallest[:-1])
    begin = np.flatnonzero(new)
    # A run goes on to the next one's start or to the last window inside the same text.
    last = np.append(begin[1:], n) - 1
    last = np.minimum(last, first[text[begin] + 1] - window)
    return Segments(text[begin], begin, last + window, grams[smallest[begin]])


@dataclass(frozen=True)
class Slice:
    """Some texts of a batch with their words, hashes and segments; ``rows`` are their rows in the batch."""

    texts: Texts
    found: Words
    hashes: np.ndarray
    segments: Segments

    def keys(self) -> np.ndarray:
        """A hash of each segment's words."""
        return range_hashes(self.hashes, self.segments.start, self.segments.end)

    def content(self, start: np.ndarray, end: np.ndarray) -> pa.Array:
        """The bytes of words ``[start, end)`` with what is between them."""
        begin, length = self.found.start[start], self.found.end[end - 1] - self.found.start[start]
        offsets = np.zeros(len(start) + 1, dtype=np.int64)
        np.cumsum(length, out=offsets[1:])
        data = self.texts.data[ranges(begin, length)]
        held = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        return held.cast(pa.binary())


def slices(column: pa.Array, window: int) -> Iterator[Slice]:
    for texts in text_slices(column):
        found = words(texts)
        hashes = word_hashes(texts.data, found)
        yield Slice(texts, found, hashes, segments_of(hashes, found.first, window))


def _one(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def _named(batch: pa.Table) -> pa.Table:
    """The rows with doc_id."""
    return batch.filter(pc.is_valid(batch.column("doc_id")))


def _first_of_each(*keys: np.ndarray) -> np.ndarray:
    """Positions of the first row of each distinct key in rows ordered by the keys."""
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _minimizers(window: int):
    """A batch's distinct minimizers: the number of distinct segments, and whether two documents have it."""

    def run(table: pa.Table) -> pa.Table:
        batch = _named(table)
        ids = _one(batch, "doc_id").to_numpy(zero_copy_only=False)
        minimizer, key, doc = [], [], []
        for some in slices(_one(batch, "text"), window):
            minimizer.append(some.segments.minimizer)
            key.append(some.keys())
            doc.append(ids[some.texts.row + some.segments.text])
        minimizer, key, doc = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (minimizer, key, doc))
        order = np.lexsort((key, minimizer))
        minimizer, key, doc = minimizer[order], key[order], doc[order]
        first = _first_of_each(minimizer)
        distinct = np.zeros(len(minimizer), dtype=np.int64)
        distinct[_first_of_each(minimizer, key)] = 1
        if len(first):
            n = np.add.reduceat(distinct, first)
            several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
        else:
            n, several = np.zeros(0, np.int64), np.zeros(0, dtype=bool)
        return pa.table(
            {
                "minimizer": minimizer[first].astype(np.uint64).view(np.int64),
                "batch": np.full(len(first), table.column("batch")[0].as_py(), dtype=np.int32),
                "n": np.where(several, -n, n).astype(np.int32),
            }
        )

    return run


def _runs(batches: Iterator[pa.RecordBatch], name: str, at_least: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole runs of rows that agree in ``name``, with their bounds; for rows ordered by it."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        if rest.num_rows >= at_least:
            starts = _first_of_each(rest.column(name).to_numpy())
            if len(starts) > 1:
                yield rest.slice(0, starts[-1]), starts
                rest = rest.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield rest, np.append(_first_of_each(rest.column(name).to_numpy()), rest.num_rows)


def _shared(many: int):
    """To each batch its minimizers that several documents have; ``common`` ones are in over ``many`` segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in _runs(batches, "minimizer", 100_000):
            minimizer, batch, n = (table.column(c).to_numpy() for c in ("minimizer", "batch", "n"))
            size = np.diff(first)
            shared = (size > 1) | (np.minimum.reduceat(n, first[:-1]) < 0)
            common = np.add.reduceat(np.abs(n).astype(np.int64), first[:-1]) > many
            rows = np.flatnonzero(np.repeat(shared, size))
            columns = [pa.array(batch[rows]), pa.array(minimizer[rows]), pa.array(np.repeat(common, size)[rows])]
            yield pa.RecordBatch.from_arrays(columns, names=["batch", "minimizer", "common"])

    return run


_SENT = pa.schema([("shard", pa.int32()), ("batch", pa.int32()), ("key", pa.int64()), ("owner", pa.int64()), ("content", pa.binary())])


def _sending(window: int, shards: int):
    """A batch's segments with shared minimizers, each once with its smallest doc_id, dealt to shards."""

    def run(table: pa.Table, shared: pa.Table) -> pa.Table:
        batch = _named(table)
        if not shared.num_rows or not batch.num_rows:
            return _SENT.empty_table()
        wanted = shared.column("minimizer").to_numpy().view(np.uint64)
        order = np.argsort(wanted)
        wanted, common = wanted[order], shared.column("common").to_numpy()[order]
        ids = _one(batch, "doc_id").to_numpy(zero_copy_only=False)
        key, route, doc, content = [], [], [], []
        for some in slices(_one(batch, "text"), window):
            at = np.minimum(np.searchsorted(wanted, some.segments.minimizer), len(wanted) - 1)
            of = np.flatnonzero(wanted[at] == some.segments.minimizer)
            single = common[at[of]]
            start, end, text = some.segments.start[of], some.segments.end[of], some.segments.text[of]
            n = np.where(single, end - start - window + 1, 1)  # a common minimizer's windows go one by one
            of, single, text = np.repeat(of, n), np.repeat(single, n), np.repeat(text, n)
            start, end = np.where(single, ranges(start, n), np.repeat(start, n)), np.repeat(end, n)
            end = np.where(single, start + window, end)
            hashes = range_hashes(some.hashes, start, end)
            owner = ids[some.texts.row + text]
            order = np.lexsort((owner, hashes))
            first = order[_first_of_each(hashes[order])]
            key.append(hashes[first])
            route.append(np.where(single[first], hashes[first], some.segments.minimizer[of[first]]))
            doc.append(owner[first])
            content.append(some.content(start[first], end[first]))
        key, route, doc = (np.concatenate(c) for c in (key, route, doc))
        order = np.lexsort((doc, key))
        first = order[_first_of_each(key[order])]
        return pa.table(
            {
                "shard": (route[first] % np.uint64(shards)).astype(np.int32),
                "batch": np.full(len(first), batch.column("batch")[0].as_py(), dtype=np.int32),
                "key": key[first].view(np.int64),
                "owner": doc[first].astype(np.int64),
                "content": pa.concat_arrays(content).take(pa.array(first)),
            },
            schema=_SENT,
        )

    return run


_ANSWER = pa.schema([("batch", pa.int32()), ("key", pa.int64()), ("owners", pa.list_(pa.int64()))])


def _answers(window: int):
    """For every segment of a shard the smallest document of each of its windows; one value if all agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in _runs(batches, "shard", 1):
            for i in range(len(first) - 1):
                yield answered(table.slice(first[i], first[i + 1] - first[i]))

    def answered(shard: pa.Table) -> pa.RecordBatch:
        key, owner = shard.column("key").to_numpy(), shard.column("owner").to_numpy()
        order = np.lexsort((owner, key))
        distinct = order[_first_of_each(key[order])]
        content = _one(shard, "content").take(pa.array(distinct))
        hashes, size = [], []
        for texts in text_slices(content):
            found = words(texts)
            hashes.append(word_hashes(texts.data, found))
            size.append(found.counts())
        hashes, size = np.concatenate(hashes), np.concatenate(size)
        bounds = np.zeros(len(size) + 1, dtype=np.int64)
        np.cumsum(size, out=bounds[1:])
        index = FMIndex(hashes, bounds, window)
        least = index.least_by_block(owner[distinct])
        found = index.matching_statistics(hashes, bounds)
        # Reported are the places where a match is as long as a window.
        at = np.flatnonzero(found.length >= window)
        text = np.searchsorted(bounds, at, side="right") - 1
        owners = least[found.block[at]]
        n = np.bincount(text, minlength=len(size))
        start = np.cumsum(n) - n
        same = np.minimum.reduceat(owners, start) == np.maximum.reduceat(owners, start)
        length = np.where(same, 1, n)
        held = owners[ranges(start, length)]
        offsets = np.zeros(len(length) + 1, dtype=np.int32)
        np.cumsum(length, out=offsets[1:])
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(held))
        each = np.searchsorted(key[distinct], key)
        return pa.RecordBatch.from_arrays([_one(shard, "batch"), _one(shard, "key"), lists.take(pa.array(each))], schema=_ANSWER)

    return run


_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("kept", pa.string()),
    ]
)


def _covered(some: Slice, ids: np.ndarray, key: np.ndarray, bounds: np.ndarray, owners: np.ndarray, window: int) -> np.ndarray:
    """Words of a slice that lie in a window with a smaller document than their own."""

    def earlier(hashes: np.ndarray, start: np.ndarray, n: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows that go, and which segments had an answer."""
        if not len(key):
            return np.zeros(0, dtype=np.int64), np.zeros(len(hashes), dtype=bool)
        at = np.minimum(np.searchsorted(key, hashes), len(key) - 1)
        known = key[at] == hashes
        at, start, n, doc = at[known], start[known], n[known], doc[known]
        given = bounds[at + 1] - bounds[at]
        place = ranges(bounds[at], n)
        place = np.where(np.repeat(given == 1, n), np.repeat(bounds[at], n), place)
        return ranges(start, n)[owners[place] < np.repeat(doc, n)], known

    s = some.segments
    doc = ids[some.texts.row + s.text]
    n = s.end - s.start - window + 1
    gone, known = earlier(some.keys(), s.start, n, doc)
    # Windows that were sent one by one.
    rest = np.flatnonzero(~known)
    start, doc = ranges(s.start[rest], n[rest]), np.repeat(doc[rest], n[rest])
    more, _ = earlier(range_hashes(some.hashes, start, start + window), start, np.ones(len(start), np.int64), doc)
    change = np.zeros(len(some.hashes) + 1, dtype=np.int64)
    for windows in (gone, more):
        np.add.at(change, windows, 1)
        np.add.at(change, windows + window, -1)
    return np.cumsum(change)[:-1] > 0


def _kept_texts(some: Slice, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    of = np.flatnonzero(kept)
    n = len(some.found.first) - 1
    length = some.found.end[of] - some.found.start[of]
    data = np.append(some.texts.data, np.uint8(0x20))[np.minimum(ranges(some.found.start[of], length + 1), len(some.texts.data))]
    after = np.cumsum(length + 1) - 1
    data[after] = 0x20
    text = some.found.text_of()[of]
    last = np.ones(len(of), dtype=bool)
    last[:-1] = text[1:] != text[:-1]
    stays = np.ones(len(data), dtype=bool)
    stays[after[last]] = False
    sizes = np.bincount(text, weights=length + 1 - last, minlength=n).astype(np.int64)
    offsets = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data[stays])]).cast(pa.string())


def _removing(window: int):
    def run(batch: pa.Table, answers: pa.Table) -> pa.Table:
        column = _one(batch, "doc_id")
        ids = column.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)  # no document is smaller
        key = answers.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key)
        lists = _one(answers, "owners").take(pa.array(order))
        bounds = lists.offsets.to_numpy().astype(np.int64)
        owners, key = lists.values.to_numpy(zero_copy_only=False), key[order]
        out = []
        for some in slices(_one(batch, "text"), window):
            gone = _covered(some, ids, key, bounds, owners, window)
            first = some.found.first
            before = np.concatenate([[0], np.cumsum(gone)])
            # Runs of removed words, counted from the text's first word.
            edge = np.zeros(len(gone) + 1, dtype=bool)
            edge[first] = True
            opens = gone & (np.append(True, ~gone[:-1])[: len(gone)] | edge[:-1])
            closes = gone & (np.append(~gone[1:], True)[: len(gone)] | edge[1:])
            begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
            of = some.found.text_of()[begin]
            spans = pa.StructArray.from_arrays([pa.array(begin - first[of]), pa.array(end - first[of])], names=["start", "end"])
            at = np.searchsorted(begin, first).astype(np.int32)
            rows = slice(some.texts.row, some.texts.row + len(some.texts))
            out.append(
                pa.RecordBatch.from_arrays(
                    [
                        column[rows], pa.array(some.found.counts()), pa.array(before[first[1:]] - before[first[:-1]]),
                        pa.ListArray.from_arrays(pa.array(at), spans), _kept_texts(some, ~gone),
                    ],
                    schema=_RESULT,
                )
            )
        return pa.Table.from_batches(out, schema=_RESULT)

    return run


def without_repeats(docs: DataFrame, window: int = 13, many: int = 20_000, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, removed, kept`` of every row.

    ``removed`` lists the runs ``[start, end)`` of words that lie in windows which also start in a document
    with a smaller doc_id; ``kept`` holds the other words, joined by one space. All windows are judged
    on the input. NULL and empty texts have no words; texts shorter than a window keep all. A row without
    doc_id neither loses nor takes words; rows with one doc_id don't take words from each other. Words are
    compared by 64-bit hashes. The windows of a minimizer that over ``many`` segments have are dealt by their
    own hashes, so that no shard grows with one phrase. Only the two named columns are read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    named = columns_as(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    # The same shuffle of the documents serves all three steps that read them.
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = parts(spark)
    batches = max(4 * tasks, -(-size // BATCH_BYTES))
    held = named.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int")).groupBy("batch")
    minimizers = held.applyInArrow(_minimizers(window), "minimizer long, batch int, n int")
    dealt = minimizers.repartition(tasks, "minimizer").sortWithinPartitions("minimizer")
    shared = map_arrow(dealt, _shared(many), "batch int, minimizer long, common boolean")
    sent = held.cogroup(shared.groupBy("batch")).applyInArrow(_sending(window, _SHARDS * batches), "shard int, batch int, key long, owner long, content binary")
    placed = sent.repartition(tasks, "shard").sortWithinPartitions("shard")
    answers = map_arrow(placed, _answers(window), "batch int, key long, owners array<long>")
    schema = "doc_id long, n_words long, n_removed long, removed array<struct<start: long, end: long>>, kept string"
    return held.cogroup(answers.groupBy("batch")).applyInArrow(_removing(window), schema)
