"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Tokens are runs of letters, digits or other visible characters, A-Z in lower case; features are the
tokens and the pairs of neighbours, hashed. A pair of equal tokens counts as one feature, "repeat",
whatever the token. A feature's value is its share of the text's features, so a text's score is the
mean weight of its features: a sparse dot product. The optimiser is FTRL-Proximal (McMahan and others,
2013), with a learning rate of its own for each weight and an L1 penalty that keeps the weights sparse.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewright.llm.frames import bounded_sample, columns_as, filter_texts, map_arrow
from galewright.llm.textarrays import Texts, Words, add_up, joined, lower_ascii, text_slices, word_hashes


@dataclass(frozen=True)
class QualitySettings:
    """``rows`` bounds the labelled texts that training reads; scoring reads every text."""

    rows: int = 6000
    buckets: int = 1 << 18
    scale: float = 20.0
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    epochs: int = 3


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float
    settings: QualitySettings


_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _SPACE
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[ord("a") : ord("z") + 1] = _LETTER
_CLASS[0x80:] = _LETTER
_REPEAT = np.uint64(0x5BD1E9955BD1E995)


def tokens(texts: Texts) -> tuple[np.ndarray, Words]:
    """The bytes in lower case, and the runs of letters, digits or other visible characters."""
    data = lower_ascii(texts.data)
    kind = _CLASS[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[texts.offsets] = True
    new = edge[: len(data)].copy()
    new[1:] |= kind[1:] != kind[:-1]
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(data))
    seen = kind[start] != _SPACE
    start, end = start[seen], end[seen]
    return data, Words(start, end, np.searchsorted(start, texts.offsets))


def features(texts: Texts, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the single tokens and of the pairs, each with the bounds of every text."""
    data, found = tokens(texts)
    hashes = word_hashes(data, found)
    one = (hashes % np.uint64(buckets)).astype(np.int64)
    pairs = joined(hashes[:-1], hashes[1:])
    pairs[hashes[:-1] == hashes[1:]] = _REPEAT
    own = np.ones(max(0, len(hashes) - 1), dtype=bool)  # pairs within one text
    last = found.first[1:-1]
    own[last[(last > 0) & (last < len(hashes))] - 1] = False
    two = (pairs[own] % np.uint64(buckets)).astype(np.int64)
    n_pairs = np.maximum(found.counts() - 1, 0)
    return [(one, found.first), (two, np.concatenate(([0], np.cumsum(n_pairs))))]


def scores(texts: Texts, model: QualityModel | None) -> np.ndarray:
    """P(label 1) of every text; the bias alone decides for a text without tokens. 0.5 without a model."""
    if model is None:
        return np.full(len(texts), 0.5)
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for bucket, first in features(texts, model.settings.buckets):
        total += add_up(model.weights[bucket], first)
        count += np.diff(first)
    z = model.bias + model.settings.scale * total / np.maximum(count, 1)
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def train(texts: list[str], labels: np.ndarray, digests: np.ndarray, settings: QualitySettings) -> QualityModel:
    """FTRL-Proximal over the texts in an order drawn from their digests."""
    order = np.argsort(digests, kind="stable")
    column = pa.array([texts[i] for i in order], pa.large_string())
    examples = []
    for part in text_slices(column):
        pieces = features(part, settings.buckets)
        for i in range(len(part)):
            ids, counts = np.unique(np.concatenate([b[f[i] : f[i + 1]] for b, f in pieces]), return_counts=True)
            examples.append((ids, settings.scale * counts / max(1, counts.sum())))
    target = np.asarray(labels)[order]
    size = settings.buckets + 1  # the last weight is the bias
    z, n = np.zeros(size), np.zeros(size)

    def weight(ids: np.ndarray) -> np.ndarray:
        l1 = np.where(ids == settings.buckets, 0.0, settings.l1)
        rate = (settings.beta + np.sqrt(n[ids])) / settings.alpha + settings.l2
        return np.where(np.abs(z[ids]) <= l1, 0.0, -(z[ids] - np.sign(z[ids]) * l1) / rate)

    for _ in range(settings.epochs):
        for (ids, value), y in zip(examples, target):
            ids, value = np.append(ids, settings.buckets), np.append(value, 1.0)
            w = weight(ids)
            p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
            gradient = (p - y) * value
            sigma = (np.sqrt(n[ids] + gradient**2) - np.sqrt(n[ids])) / settings.alpha
            z[ids] += gradient - sigma * w
            n[ids] += gradient**2
    w = weight(np.arange(size))
    return QualityModel(w[:-1].astype(np.float32), float(w[-1]), settings)


def training_texts(docs: DataFrame, labels: DataFrame, settings: QualitySettings) -> DataFrame:
    """``text, label, digest``: at most ``rows`` distinct rows of the documents that the sampled labels name."""
    named = labels.where("label IN (0, 1) AND doc_id IS NOT NULL")
    named = named.groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit("order"))
    sample = bounded_sample(named, F.col("doc_id"), settings.rows).orderBy(order).limit(settings.rows)
    texts = docs.join(F.broadcast(sample), "doc_id")  # at most settings.rows rows
    texts = texts.select(F.coalesce("text", F.lit("")).alias("text"), "label", F.xxhash64("doc_id", "text").alias("digest"))
    return texts.dropDuplicates(["digest"]).orderBy("digest").limit(settings.rows)  # an id may have any number of rows


def fit(docs: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings(), doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> QualityModel | None:
    """A model from the labelled documents; None without any.

    ``labels`` has one row per labelled document: ``doc_id`` and 0 or 1; rows with other or no labels
    are left out. A sample of at most ``settings.rows`` of them, chosen by a digest of doc_id, is sent
    to the documents, and one task trains on as many of their texts, each taken once.
    """
    texts = training_texts(columns_as(docs, doc_id=doc_id, text=text), columns_as(labels, doc_id=doc_id, label=label), settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if rows:
            found = pa.Table.from_batches(rows)
            digests = found.column("digest").to_numpy().view(np.uint64)
            model = train(found.column("text").to_pylist(), found.column("label").to_numpy(), digests, settings)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    row = map_arrow(texts.repartition(1), run, "model binary").first()
    return pickle.loads(row.model) if row else None


def rate(docs: DataFrame, model: QualityModel | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` of every row; only the two named columns are read.

    ``score`` is the probability of label 1, ``predicted`` 1 from 0.5 on. NULL and empty texts have the
    score of the bias alone; without a model every score is 0.5. Equal texts score equally.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for texts in text_slices(batch.column("text")):
                found = scores(texts, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(texts.row, len(texts)), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                    names=["doc_id", "score", "predicted"],
                )

    named = columns_as(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_arrow(named, run, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, model: QualityModel | None, text: str = "text") -> DataFrame:
    """The rows with the prediction 1, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return filter_texts(docs, lambda texts: scores(texts, shared.value) >= 0.5, text)
