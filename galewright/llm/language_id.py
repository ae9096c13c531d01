"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text's subwords are the byte n-grams of its letters, word bounds included, hashed into a fixed number
of rows. Their embeddings are averaged and a linear layer gives the languages' logits, as in fastText.
Embeddings and layer are trained by stochastic gradient descent in numpy. Held-out training texts
give a temperature that calibrates the probabilities.

Probabilities compare the learned languages with each other and can't tell that a text is in none of them.
So the model also remembers which subwords training met, and learns on held-out segments what share of
their subwords is known: of its own language's segments, and of each language's when that language is
left out. The threshold lies between the two. A text whose share is surely below it is rejected, and its score
falls with the share; so is a text whose best probability is below ``reject_below``.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewright.llm.frames import bounded_sample, columns_as, filter_texts, map_arrow
from galewright.llm.textarrays import Texts, add_up, lower_ascii, mixed, sums, text_slices

UNKNOWN = "und"
#: Bytes of text scored at once: each subword takes over a hundred bytes on the way.
_SLICE = 1 << 19


@dataclass(frozen=True)
class LanguageSettings:
    """``rows_per_language`` bounds the labelled texts that training reads; scoring reads every text."""

    rows_per_language: int = 300
    buckets: int = 1 << 16
    dimension: int = 16
    sizes: tuple[int, ...] = (2, 3, 4)
    segment_words: tuple[int, ...] = (3, 12, 48)
    epochs: int = 3
    rate: float = 1.0
    held_out_in: int = 5
    reject_below: float = 0.4
    #: Share of learned languages' held-out segments that may fall below the known share's threshold.
    lost: float = 0.002
    #: Further below that share a text must fall: odd names, numbers and misspellings are no other language.
    slack: float = 0.85
    #: A text's known share counts with so many standard deviations in its favour.
    doubt: float = 3.0


@dataclass
class LanguageModel:
    languages: list[str]
    embedding: np.ndarray
    layer: np.ndarray
    temperature: float
    known: np.ndarray
    least_known: float
    settings: LanguageSettings

    def logits_by_bucket(self) -> np.ndarray:
        return (self.embedding @ self.layer).astype(np.float32)


_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[0x80:] = True


def letters_only(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The texts in lower case (ASCII and Latin-1 letters) with a blank for every other byte, a blank
    around each text; and where each text begins."""
    low = lower_ascii(texts.data)
    capital = np.zeros(len(low), dtype=bool)
    capital[1:] = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97)
    low = low + np.where(capital, 0x20, 0).astype(np.uint8)
    low = np.where(_LETTER[low], low, np.uint8(0x20))
    n = len(texts)
    out = np.full(len(low) + n + 1, 0x20, dtype=np.uint8)
    out[np.arange(len(low)) + np.repeat(np.arange(1, n + 1), np.diff(texts.offsets))] = low
    return out, texts.offsets + np.arange(n + 1)


def subwords(letters: np.ndarray, settings: LanguageSettings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size, the hashes of all n-grams without a blank inside and their ascending positions."""
    inner = letters != 0x20
    value = letters.astype(np.uint64)
    whole = np.ones(len(letters), dtype=bool)  # no blank after the first byte and before the last
    for size in range(2, max(settings.sizes) + 1):
        n = max(0, len(letters) - size + 1)
        if size > 2:
            whole = whole[:n] & inner[size - 2 : size - 2 + n]
        value = value[:n] | (letters[size - 1 :].astype(np.uint64) << np.uint64(8 * (size - 1)))
        if size in settings.sizes:
            at = np.flatnonzero(whole[:n] & (inner[:n] | inner[size - 1 :]) if size == 2 else whole[:n])
            yield mixed(value[at] + np.uint64(size << 56)), at


def buckets_of(hashed: np.ndarray, settings: LanguageSettings) -> np.ndarray:
    return (hashed % np.uint64(settings.buckets)).astype(np.int64)


def remembered(hashes: np.ndarray) -> np.ndarray:
    """A set of hashes as bits, 32 or more for each; one in 32 others passes for a member."""
    hashes = np.unique(hashes)
    size = 1 << max(16, (32 * len(hashes) - 1).bit_length())
    bits = np.zeros(size, dtype=np.uint8)
    bits[(hashes % np.uint64(size)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little")


def is_remembered(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes % np.uint64(8 * len(known))).astype(np.int64)
    return (known[at >> 3] >> (at & 7).astype(np.uint8)) & 1


def surely_at_most(seen: np.ndarray, of: np.ndarray, doubt: float) -> np.ndarray:
    """Wilson's upper bound of a share: few subwords leave much room."""
    n = np.maximum(of, 1)
    share, room = seen / n, doubt * doubt / n
    return (share + room / 2 + doubt * np.sqrt(share * (1 - share) / n + room / (4 * n))) / (1 + room)


def mean_logits(texts: Texts, by_bucket: np.ndarray, known: np.ndarray, settings: LanguageSettings) -> tuple[np.ndarray, ...]:
    """For every text the mean of its subwords' logits, whether it has a letter, and how many of its
    longest subwords are known, of how many."""
    letters, begin = letters_only(texts)
    total, count = np.zeros((len(texts), by_bucket.shape[1])), np.zeros(len(texts), dtype=np.int64)
    seen, of = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    for size, (hashed, place) in zip(sorted(settings.sizes), subwords(letters, settings)):
        first = np.searchsorted(place, begin)
        total += add_up(by_bucket[buckets_of(hashed, settings)], first)
        count += np.diff(first)
        if size == max(settings.sizes):
            seen, of = sums(is_remembered(known, hashed), first), np.diff(first)
    has = count > 0
    # Bytes above ASCII may be no letters; ask only where no ASCII letter settles it.
    plain = np.zeros(len(letters) + 1, dtype=np.int64)
    np.cumsum((letters != 0x20) & (letters < 0x80), out=plain[1:])
    for i in np.flatnonzero(has & (plain[begin[1:]] == plain[begin[:-1]])):
        raw = texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes().decode()
        has[i] = any(c.isalpha() for c in raw)
    return total / np.maximum(count, 1)[:, None], has, seen, of


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(texts: list[str], labels: list[str], digests: np.ndarray, settings: LanguageSettings) -> LanguageModel:
    """Fit on whole texts, cut into segments of several lengths so that short texts are met too."""
    languages = sorted(set(labels))
    code = {x: i for i, x in enumerate(languages)}
    rng = np.random.default_rng(11)
    embedding = np.zeros((settings.buckets, settings.dimension))
    layer = rng.normal(0, 1 / np.sqrt(settings.dimension), (settings.dimension, len(languages)))
    examples: dict[bool, list[tuple[np.ndarray, np.ndarray, int, np.ndarray]]] = {False: [], True: []}
    for i in np.argsort(digests, kind="stable"):
        held = bool(digests[i] % settings.held_out_in == 0)
        for segment in _segments(texts[i], settings.segment_words):
            column = pa.array([segment])
            for one in text_slices(column):
                hashed = [h for h, _ in subwords(letters_only(one)[0], settings)]
            bucket = buckets_of(np.concatenate(hashed), settings)
            if len(bucket):
                ids, counts = np.unique(bucket, return_counts=True)
                examples[held].append((ids.astype(np.int32), counts / counts.sum(), code[labels[i]], hashed[-1]))
    fit, check = examples[False] or examples[True], examples[True] or examples[False]
    steps, done = settings.epochs * len(fit), 0
    for _ in range(settings.epochs):
        for k in rng.permutation(len(fit)):
            ids, share, target, _ = fit[k]
            rate = settings.rate * (1 - done / steps)
            done += 1
            rows = embedding[ids]
            mean = share @ rows
            error = _softmax(mean @ layer)
            error[target] -= 1
            back = layer @ error
            layer -= rate * np.outer(mean, error)
            # A subword's step is not divided by the text's length, as in fastText.
            embedding[ids] = rows - rate * np.minimum(share * len(ids), 1.0)[:, None] * back * 0.1
    logits = np.array([share @ embedding[ids] @ layer for ids, share, *_ in check]).reshape(-1, len(languages))
    target = np.array([t for _, _, t, _ in check], dtype=np.int64)
    def loss(temperature: float) -> float:
        return float(-np.log(_softmax(logits / temperature)[np.arange(len(target)), target] + 1e-12).mean())
    grid = np.geomspace(0.02, 20, 61)
    temperature = float(min(grid, key=loss)) if len(target) else 1.0
    known, least = _familiar(fit, check, len(languages), settings)
    return LanguageModel(languages, embedding.astype(np.float32), layer, temperature, known, least, settings)


def _familiar(fit: list, check: list, languages: int, settings: LanguageSettings) -> tuple[np.ndarray, float]:
    """The subwords met in training, and the least known share of a text in a learned language.

    With a single language there is nothing to leave out, and only its own segments set the threshold.
    """
    none = np.zeros(0, dtype=np.uint64)
    met = [np.unique(np.concatenate([none, *(h for *_, t, h in fit if t == k)])) for k in range(languages)]
    everywhere, times = np.unique(np.concatenate([none, *met]), return_counts=True)
    own, foreign = [], []
    for *_, target, hashed in check:
        if not len(hashed):
            continue
        at = np.minimum(np.searchsorted(everywhere, hashed), max(len(everywhere) - 1, 0))
        count = np.where(everywhere[at] == hashed, times[at], 0) if len(everywhere) else np.zeros(len(hashed), np.int64)
        left = count - np.isin(hashed, met[target])
        for shares, n in ((own, (count > 0).sum()), (foreign, (left > 0).sum())):
            shares.append(float(surely_at_most(n, np.array(len(hashed)), settings.doubt)))
    low = float(np.quantile(own, settings.lost)) if own else 0.0
    high = float(np.quantile(foreign, 0.5)) if foreign and languages > 1 else low
    return remembered(everywhere), min(settings.slack * low, (low + 2 * high) / 3)


def _segments(text: str, lengths: tuple[int, ...]) -> Iterator[str]:
    found, at, k = text.split(), 0, 0
    while at < len(found):
        yield " ".join(found[at : at + lengths[k % len(lengths)]])
        at += lengths[k % len(lengths)]
        k += 1


def training_rows(labelled: DataFrame, settings: LanguageSettings) -> DataFrame:
    """``text, lang, digest``: about ``rows_per_language`` distinct rows of each language, or fewer."""
    named = labelled.where("text IS NOT NULL AND lang IS NOT NULL")
    digest = F.xxhash64(F.col("doc_id").cast("string"), "text")
    sample = bounded_sample(named, digest, settings.rows_per_language, per=F.col("lang"))
    return sample.select("text", "lang", digest.alias("digest")).dropDuplicates(["lang", "digest"])


def fit(labelled: DataFrame, settings: LanguageSettings = LanguageSettings(), doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel | None:
    """A model from the rows with text and language; None without such rows.

    Reads a sample of about ``rows_per_language`` rows of each language, chosen by a digest of doc_id and
    text and each taken once, and trains in one task, so a language, an id or a text may hold any share of the rows.
    """
    sample = training_rows(columns_as(labelled, doc_id=doc_id, text=text, lang=lang), settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if rows:
            found = pa.Table.from_batches(rows).to_pydict()
            model = train(found["text"], found["lang"], np.array(found["digest"], dtype=np.int64).view(np.uint64), settings)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    row = map_arrow(sample.repartition(1), run, "model binary").first()
    return pickle.loads(row.model) if row else None


def identify(docs: DataFrame, model: LanguageModel | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every row; only the two named columns are read.

    ``score`` is the calibrated probability of the predicted language, lowered where fewer subwords are known
    than in any learned language. NULL texts and texts without a letter are ``und`` with score 0, and
    rejected; so is everything without a model. Other texts are rejected below ``reject_below``, or where their
    known share is surely below the learned threshold. Equal texts score equally; ties go to the first language by name.
    """
    shared = _shared(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for texts in text_slices(batch.column("text"), _SLICE):
                names, score, rejected = _verdicts(texts, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(texts.row, len(texts)), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                    names=["doc_id", "lang_pred", "score", "rejected"],
                )

    named = columns_as(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_arrow(named, run, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """The rows that ``identify`` doesn't reject, all columns as they are, repeated rows too. NULL texts go; an empty
    table stays empty; without a model no row stays."""
    shared = _shared(docs, model)
    return filter_texts(docs, lambda texts: ~_verdicts(texts, shared.value)[2], text, _SLICE)


def _shared(docs: DataFrame, model: LanguageModel | None) -> Broadcast:
    """The model for the workers: a row of logits for each bucket, whatever the corpus holds."""
    parts = model and (model.logits_by_bucket(), model.temperature, model.known, model.least_known, model.languages, model.settings)
    return docs.sparkSession.sparkContext.broadcast(parts)


def _verdicts(texts: Texts, parts: tuple | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language, calibrated probability and rejection of every text."""
    n = len(texts)
    if not parts:
        return np.full(n, UNKNOWN, dtype=object), np.zeros(n), np.ones(n, dtype=bool)
    by_bucket, temperature, known, least, languages, settings = parts
    logits, has, seen, of = mean_logits(texts, by_bucket, known, settings)
    probability = _softmax(logits / temperature)
    names = np.where(has, np.array(languages, dtype=object)[probability.argmax(axis=1)], UNKNOWN)
    share = np.where(of > 0, surely_at_most(seen, of, settings.doubt), 1.0)  # one or two letters tell nothing
    best = probability.max(axis=1)
    score = np.where(has, best * np.minimum(1.0, share / max(least, 1e-9)), 0.0)
    return names, score, ~has | (best < settings.reject_below) | (share < least)
