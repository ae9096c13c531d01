"""Spelling variants by a variable-length gram index (Li, Wang and Yang, VGRAM, 2007).

Grams of two code points are split further, up to ``MOST`` code points, where they are frequent: the
dictionary holds a longer gram if its prefix is frequent and it isn't rare itself. A word decomposes
into the longest dictionary gram at each position, without those inside an earlier one. One edit can
affect only so many of a word's grams; the bound follows from the dictionary, position by position.
Near words therefore share one of their (bound + 1) rarest grams, at the same place or one further, in
words of the length that the edit gives: these lists are merged, and each candidate pair is verified.
Words that one edit may rob of all grams have another index of two-point grams only, where the bound is 2.

Words are handled as one byte a code point, so code points must be below U+0100.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewright.llm.buckets import dealt, pairs_within, whole_buckets
from galewright.llm.frames import columns_as, drop_written, map_arrow, materialize
from galewright.llm.textarrays import Texts, lower_ascii, mixed, ranges, runs, text_slices, word_hashes

LEAST, MOST = 2, 4
#: No dictionary has more grams than this, whatever the number of words.
DICTIONARY = 1 << 19
#: A gram is split further from this many times the count at which grams are kept.
_SPLIT = 4
_START, _END = 1, 2
_LEAD = 0xC3
_CELLS = 1 << 20

_CRC_TABLE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC_TABLE = np.where(_CRC_TABLE & 1, (_CRC_TABLE >> 1) ^ np.uint32(0xEDB88320), _CRC_TABLE >> 1)


def crc32_each(data: np.ndarray, start: np.ndarray, end: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of every ``data[start:end]`` continued from the crc32 ``before``; all runs advance together."""
    state = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    length = end - start
    order = np.argsort(-length, kind="stable")
    together = 48
    falling = -length[order]
    for step in range(min(together, int(length.max(initial=0)))):
        at = order[: np.searchsorted(falling, -step, side="left")]
        state[at] = _CRC_TABLE[(state[at] ^ data[start[at] + step]) & 0xFF] ^ (state[at] >> np.uint32(8))
    state ^= np.uint32(0xFFFFFFFF)
    for i in order[: np.searchsorted(falling, -together, side="left")]:
        state[i] = zlib.crc32(data[start[i] + together : end[i]].tobytes(), int(state[i]))
    return state


def letter_runs(texts: Texts, ids: list, least: int, lose: int) -> tuple[pa.Array, np.ndarray]:
    """Words of the texts and their counts: maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case.

    Where ``lose`` divides h, the crc32 of ``<id>:<run>``, the run loses its code point h % length. Only
    words of ``least`` code points count. Bytes C3 lead just the code points U+00C0 to U+00FF.
    """
    data = lower_ascii(texts.data)
    lead = data == _LEAD
    inside = ((data >= ord("a")) & (data <= ord("z"))) | lead
    inside[1:] |= lead[:-1]
    found = runs(inside, texts.offsets)
    if not len(found.start):
        return pa.array([], pa.string()), np.zeros(0, np.int64)
    leads = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(lead, out=leads[1:])
    points = found.end - found.start - (leads[found.end] - leads[found.start])
    prefix = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], dtype=np.uint32)
    h = crc32_each(data, found.start, found.end, prefix[found.text_of()])
    losing = h % np.uint32(lose) == 0
    shorter = []
    for i in np.flatnonzero(losing & (points > least)):
        word = data[found.start[i] : found.end[i]].tobytes().decode()
        cut = int(h[i]) % len(word)
        shorter.append(word[:cut] + word[cut + 1 :])
    whole = np.flatnonzero(~losing & (points >= least))
    _, first, counts = np.unique(word_hashes(data, found)[whole], return_index=True, return_counts=True)
    first = whole[first]
    length = found.end[first] - found.start[first]
    offsets = np.zeros(len(first) + 1, dtype=np.int64)
    np.cumsum(length, out=offsets[1:])
    held = data[ranges(found.start[first], length)]
    words = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(held)]).cast(pa.string())
    return pa.concat_arrays([words, pa.array(shorter, pa.string())]), np.append(counts, np.ones(len(shorter), np.int64))


def counted_words(docs: DataFrame, least: int = 5, often: int = 3, lose: int = 97, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n)``: words of ``letter_runs`` that occur ``often`` times in all texts together.

    Each text's words are counted where they stand, so a frequent word is one row a slice of texts. NULL
    texts have no words; a row without id takes the empty id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for texts in text_slices(batch.column("text")):
                words, n = letter_runs(texts, ids[texts.row : texts.row + len(texts)], least, lose)
                yield pa.RecordBatch.from_arrays([words, pa.array(n)], names=["word", "n"])

    found = map_arrow(columns_as(docs, doc_id=doc_id, text=text), run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= often)


def single_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words' code points, one byte each, and their bounds."""
    ((texts),) = text_slices(column, limit=1 << 62) if len(column) else (Texts(0, np.zeros(0, np.uint8), np.zeros(1, np.int64)),)
    data = texts.data
    lead = data >= 0xC0
    if (data[lead] > _LEAD).any() or (data <= _END).any():
        raise ValueError("words need code points from U+0003 to U+00FF")
    raised = np.zeros(len(data), dtype=bool)
    raised[1:] = data[:-1] == _LEAD
    before = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(lead, out=before[1:])
    return (data + np.where(raised, np.uint8(0x40), np.uint8(0)))[~lead], texts.offsets - before[texts.offsets]


def by_length(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of words of one length, and these words as a matrix with a start and an end mark."""
    length = np.diff(offsets)
    for n in np.unique(length):
        of = np.flatnonzero(length == n)
        step = max(1, _CELLS // (int(n) + 2))
        for rows in np.split(of, range(step, len(of), step)):
            marked = np.empty((len(rows), n + 2), dtype=np.uint8)
            marked[:, 0], marked[:, -1] = _START, _END
            marked[:, 1:-1] = data[offsets[rows][:, None] + np.arange(n)]
            yield rows, marked


def gram_keys(marked: np.ndarray, most: int) -> dict[int, np.ndarray]:
    """Grams by length, each as the number its bytes spell; no byte is 0, so the number tells the length."""
    keys = {1: marked.astype(np.uint64)}
    for q in range(2, min(most, marked.shape[1]) + 1):
        keys[q] = (keys[q - 1][:, :-1] << np.uint64(8)) | keys[1][:, q - 1 :]
    return keys


def _in(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(keys.shape, dtype=bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[at] == keys


@dataclass(frozen=True)
class Dictionary:
    """Longer grams (closed under prefixes), with counts of all grams known; arrays are sorted."""

    longer: np.ndarray
    known: np.ndarray
    counts: np.ndarray

    @staticmethod
    def pruned(known: np.ndarray, counts: np.ndarray, least: int) -> Dictionary:
        """From counted grams: longer ones of ``least`` occurrences whose prefix has over ``_SPLIT`` times as many."""
        order = np.argsort(known)
        known, counts = known[order], counts[order]
        prefix = known >> np.uint64(8)
        at = np.minimum(np.searchsorted(known, prefix), max(len(known) - 1, 0))
        often = np.where(known[at] == prefix, counts[at], 0) if len(known) else counts
        longer = known[(known >= np.uint64(1 << 8 * LEAST)) & (counts >= least) & (often > _SPLIT * least)]
        return Dictionary(longer, known, counts)

    def without_longer(self) -> Dictionary:
        return Dictionary(self.longer[:0], self.known, self.counts)

    def extendable(self) -> np.ndarray:
        return np.unique(self.longer >> np.uint64(8))

    def suffixes(self) -> np.ndarray:
        """Proper suffixes of longer grams, of ``LEAST`` code points or more."""
        found = [self.longer[:0]]
        for q in range(LEAST, MOST):
            found.append(self.longer[self.longer >= np.uint64(1 << 8 * q)] & np.uint64((1 << 8 * q) - 1))
        return np.unique(np.concatenate(found))


@dataclass(frozen=True)
class Decomposed:
    """A word a row: where grams start (``kept``), their lengths and keys, and how many one edit can affect."""

    kept: np.ndarray
    length: np.ndarray
    key: np.ndarray
    affected: np.ndarray


def decompose(marked: np.ndarray, grams: Dictionary, extendable: np.ndarray, suffixes: np.ndarray) -> Decomposed:
    """The words' variable grams and the bound on those that one edit affects.

    A gram is chosen from the code points that follow its start for as long as these spell the
    beginning of a dictionary gram. An edit at i thus changes the choice only at starts from which the
    text up to i can go on (the first is ``touched``); it can also swallow grams between there and i, and
    grams behind i that lie inside a suffix of a dictionary gram that begins there (up to ``reach``).
    """
    n, width = marked.shape
    keys = gram_keys(marked, MOST)
    starts = width - LEAST + 1
    length = np.full((n, starts), LEAST, dtype=np.int64)
    key = keys[LEAST].copy()
    for q in range(LEAST + 1, min(MOST, width) + 1):
        hit = _in(grams.longer, keys[q])
        length[:, : hit.shape[1]][hit] = q
        key[:, : hit.shape[1]][hit] = keys[q][hit]
    end = np.arange(starts) + length
    kept = np.ones((n, starts), dtype=bool)
    kept[:, 1:] = end[:, 1:] > np.maximum.accumulate(end, axis=1)[:, :-1]
    # For every position: the first start that is touched, and how far a suffix from there reaches.
    touched = np.broadcast_to(np.maximum(np.arange(width + 1) - LEAST + 1, 0), (n, width + 1)).copy()
    reach = np.broadcast_to(np.arange(width + 1), (n, width + 1)).copy()
    for q in range(LEAST, min(MOST, width + 1)):
        row, at = np.nonzero(_in(extendable, keys[q]))
        touched[row, at + q] = at
        row, at = np.nonzero(_in(suffixes, keys[q]))
        reach[row, at] = at + q
    before = np.zeros((n, width + 2), dtype=np.int64)  # kept grams that start before a position
    np.cumsum(kept, axis=1, out=before[:, 1 : starts + 1])
    before[:, starts + 1 :] = before[:, starts : starts + 1]
    ending = np.zeros((n, width + 1), dtype=np.int64)  # kept grams that end at or before a position
    for p in range(starts):
        ending[np.arange(n), end[:, p]] += kept[:, p]
    ending = np.cumsum(ending, axis=1)
    row = np.arange(n)
    affected = np.zeros(n, dtype=np.int64)
    for i in range(1, width):
        first = before[row, touched[:, i]]
        swallowed = [np.maximum(ending[row, reach[:, a]] - before[:, a], 0) for a in (i, i + 1)]
        affected = np.maximum(affected, before[:, i] - first + swallowed[0])  # a code point put in before i
        if i < width - 1:  # the code point at i replaced or taken out
            affected = np.maximum(affected, before[:, i + 1] - first + swallowed[1])
    return Decomposed(kept, length, key, affected)


def rarest(found: Decomposed, grams: Dictionary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and key of each word's (affected + 1) rarest grams, and the words that have no more than are affected."""
    row, start = np.nonzero(found.kept)
    key = found.key[row, start]
    at = np.minimum(np.searchsorted(grams.known, key), max(len(grams.known) - 1, 0))
    often = np.where(grams.known[at] == key, grams.counts[at], 0) if len(grams.known) else np.zeros(len(key), np.int64)
    order = np.lexsort((start, key, often, row))
    row, start, key = row[order], start[order], key[order]
    size = found.kept.sum(axis=1)
    rank = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    chosen = rank <= found.affected[row]
    return row[chosen], start[chosen], key[chosen], size <= found.affected


def gram_dictionary(words: DataFrame) -> Dictionary:
    """The pruned dictionary of a table of distinct words.

    All two-point grams and the longer ones that occur in enough words come to the driver: no more than
    ``DICTIONARY`` of the longer ones, since the count at which they are kept grows with the words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, marked in by_length(*single_bytes(batch.column("word"))):
                found = gram_keys(marked, MOST)
                grams, n = np.unique(np.concatenate([found[q].ravel() for q in found if q >= LEAST]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n)], names=["gram", "n"])

    counted = map_arrow(words.select("word"), run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counted = materialize(counted, "grams")
    total = counted.agg(F.sum("n")).first()[0] or 0
    least = max(4, -(-total // DICTIONARY))
    rows = counted.where((F.col("n") >= least) | (F.col("gram") < 1 << 8 * LEAST)).toArrow()
    drop_written(counted)
    known, counts = (rows.column(c).to_numpy() for c in ("gram", "n"))
    return Dictionary.pruned(known.view(np.uint64), counts, least)


def _keyed(words: DataFrame, grams: Dictionary) -> DataFrame:
    """The words in the lists of their rarest grams.

    A list is a gram at a place in words of one length. A word stands in its own lists, and asks
    (``asks``) those of words one code point longer, where the gram may have moved by one.
    """
    indexes = []
    for part, held in enumerate((grams, grams.without_longer())):
        indexes.append((part, held, held.extendable(), held.suffixes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, marked in by_length(*single_bytes(batch.column("word"))):
                for part, held, extendable, suffixes in indexes:
                    row, start, key, robbed = rarest(decompose(marked, held, extendable, suffixes), held)
                    points = marked.shape[1] - 2
                    for shift, longer in ((0, 0), (0, 1), (1, 1)):
                        place = (start + shift).astype(np.uint64) << np.uint64(32) | np.uint64(points + longer)
                        bucket = mixed(mixed(key) ^ place)
                        n = len(row)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(n, part, np.int32)), pa.array(bucket.view(np.int64)),
                                batch.column("word").take(pa.array(rows[row])), batch.column("n").take(pa.array(rows[row])),
                                pa.array(np.full(n, bool(longer))),
                            ],
                            names=["part", "key", "word", "n", "asks"],
                        )
                    rows, marked = rows[robbed], marked[robbed]
                    if not len(rows):
                        break

    return map_arrow(words.select("word", "n"), run, "part int, key long, word string, n long, asks boolean")


def one_edit(data: np.ndarray, offsets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Do words a and b differ by exactly one inserted, deleted or replaced code point?"""
    size = np.diff(offsets)
    swap = size[a] > size[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    out = np.zeros(len(a), dtype=bool)
    gap = size[b] - size[a]
    for n in np.unique(size[a][gap <= 1]):
        for more in (0, 1):
            of = np.flatnonzero((size[a] == n) & (gap == more))
            step = max(1, _CELLS // (int(n) + 1))
            for some in np.split(of, range(step, len(of), step)):
                left = data[offsets[a[some]][:, None] + np.arange(n)]
                right = data[offsets[b[some]][:, None] + np.arange(n + more)]
                if more:
                    same = np.logical_and.accumulate(left == right[:, :-1], axis=1).sum(axis=1)
                    same += np.logical_and.accumulate((left == right[:, 1:])[:, ::-1], axis=1).sum(axis=1)
                    out[some] = same >= n
                else:
                    out[some] = (left != right).sum(axis=1) == 1
    return out


def _near(keyed: DataFrame, block: int) -> DataFrame:
    """``word, near, near_n``, both ways, once for each list where a pair meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in whole_buckets(batches):
            words, n = table.column("word").combine_chunks(), table.column("n").to_numpy()
            asks, own = table.column("asks").to_numpy(), table.column("own").to_numpy()
            apart = table.column("i").to_numpy() != table.column("j").to_numpy()
            data, offsets = single_bytes(words)
            for a, b in pairs_within(first):
                new = ~(asks[a] & asks[b]) & (~apart[a] | (own[a] != own[b]))
                a, b = a[new], b[new]
                hit = one_edit(data, offsets, a, b)
                a, b = np.append(a[hit], b[hit]), np.append(b[hit], a[hit])
                if len(a):
                    columns = [words.take(pa.array(a)), words.take(pa.array(b)), pa.array(n[b])]
                    yield pa.RecordBatch.from_arrays(columns, names=["word", "near", "near_n"])

    return map_arrow(dealt(keyed, "word", block), run, "word string, near string, near_n long")


def variant_groups(words: DataFrame, block: int = 2048, ratio: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a table of distinct words with their counts n.

    ``n_near`` counts the words one edit away. ``form`` is the most frequent of them (ties: the smallest in
    code-point order) if it occurs ``ratio`` times as often, else NULL; ``root`` is where the forms lead. An
    empty table gives no rows; a NULL word or count is left out. Words of any length are handled.
    """
    words = materialize(words.select("word", F.col("n").cast("long").alias("n")).where("word IS NOT NULL AND n IS NOT NULL"), "words")
    keyed = materialize(_keyed(words, gram_dictionary(words)), "keys")
    pairs = _near(keyed, block).dropDuplicates(["word", "near"])
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best")
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best)
    often = -F.col("best.rank") >= ratio * F.col("n")
    found = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(often, F.col("best.near")).alias("form"),
        F.when(often, -F.col("best.rank")).alias("form_n"),
    )
    found = materialize(found, "forms")
    drop_written(keyed)
    roots = _roots(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    joined = found.join(roots, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """Follow the links by doubling. Each form occurs ``ratio`` times as often as its word, so there are no circles."""
    now = materialize(links, "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = now.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        after = materialize(after, "roots")
        drop_written(now)
        now = after
        if now.where("moved").isEmpty():
            return now.select("word", "root")


def groups_sql(least: int = 5, often: int = 3, lose: int = 97) -> str:
    """DuckDB's form of the query: near words meet in the texts that remain when one code point goes."""
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""WITH RECURSIVE crc AS (SELECT list(c ORDER BY i) AS crc_table FROM (SELECT i, list_reduce([i] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1))) AS c FROM range(256) r(i))),
runs AS (SELECT COALESCE(CAST(doc_id AS VARCHAR), '') AS doc_id, {lower.format("unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]+'))")} AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
hashed AS (SELECT run, n, xor(4294967295, list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(concat(doc_id, ':', run), ''),
    lambda x: CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)] ELSE [195::BIGINT, CAST(ord(x) - 64 AS BIGINT)] END)),
    lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1]))) AS h FROM counted, crc),
typed AS (SELECT CASE WHEN h % {lose} = 0 THEN concat(substr(run, 1, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM typed WHERE length(word) >= {least} GROUP BY word HAVING sum(n) >= {often}),
gone AS (SELECT word, n, pos, concat(substr(word, 1, pos - 1), substr(word, pos + 1)) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS pos FROM words)),
pairs AS (SELECT a.word, b.word AS near, b.n AS near_n FROM gone a JOIN gone b ON a.pos = b.pos AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gone a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM gone a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS most FROM pairs GROUP BY word),
first AS (SELECT p.word, min(p.near) AS near FROM pairs p JOIN best b ON b.word = p.word AND b.most = p.near_n GROUP BY p.word),
forms AS (SELECT w.word, w.n, COALESCE(b.n_near, 0) AS n_near, CASE WHEN b.most >= 2 * w.n THEN f.near END AS form, CASE WHEN b.most >= 2 * w.n THEN b.most END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word LEFT JOIN first f ON f.word = w.word),
walk AS (SELECT word, word AS reached FROM forms UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.reached WHERE forms.form IS NOT NULL),
roots AS (SELECT walk.word, walk.reached AS root FROM walk JOIN forms ON forms.word = walk.reached WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""
