"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Gong and Lazebnik's iterative quantisation (2011) learns a rotation of the principal axes under which
the signs of the coordinates are balanced and lose little; the signs are a vector's code. Codes are cut
into substrings, one table each: codes that differ in few bits agree in some substring but for a bit
or two (Norouzi and others, 2012). Candidates are ranked again by the cosine of the original vectors.

Groups of near copies never become pairs. Equal vectors are one node. A vector within half the angle of
the threshold of its leader shares the leader's cell, and by the triangle inequality all vectors of a
cell link with each other. Only candidates from different cells are compared one by one.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import acos, ceil, comb, cos

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewright.llm.buckets import dealt, pairs_within, whole_buckets
from galewright.llm.components import components
from galewright.llm.frames import columns_as, drop_written, map_arrow, materialize, ship_package


@dataclass(frozen=True)
class VectorSettings:
    """Each length's rotation and index are fitted on about ``sample`` vectors; every vector is indexed.

    ``recall`` is what an index has to find of the pairs at the threshold. ``prior`` random directions join
    the sample of the rotation: they outweigh a few vectors, and many vectors outweigh them. An index is chosen as
    for ``planned`` vectors or more, so small tables are met by the index of larger ones. ``piece`` is the
    number of components whose vectors are encoded together.
    """

    threshold: float = 0.9
    sample: int = 5000
    prior: int = 500
    bits: int = 256
    rounds: int = 50
    block: int = 2048
    recall: float = 0.97
    planned: int = 100_000
    piece: int = 4_000_000


@dataclass(frozen=True)
class Index:
    """``tables`` substrings of ``width`` bits, met within ``flips`` bits; candidates go on to the cosine up to
    a distance of ``radius`` of whole codes. Vectors of half the angle seldom differ in more than ``near`` bits."""

    tables: int
    width: int
    flips: int
    radius: int
    near: int

    def packed(self) -> int:
        """As one integer, which travels with every code."""
        return self.tables | self.width << 8 | self.flips << 16 | self.radius << 24 | self.near << 40

    @staticmethod
    def unpacked(of: int) -> Index:
        return Index(of & 255, of >> 8 & 255, of >> 16 & 255, of >> 24 & 65535, of >> 40)


@dataclass
class Rotation:
    mean: np.ndarray
    axes: np.ndarray

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """The signs of the rotated coordinates, 64 in each of a row's integers."""
        signs = np.packbits((unit - self.mean) @ self.axes > 0, axis=1, bitorder="little")
        return np.ascontiguousarray(signs).view("<u8").astype(np.uint64)


def fit_rotation(unit: np.ndarray, settings: VectorSettings) -> Rotation:
    """Principal axes, then turns that bring the coordinates and their signs together."""
    rng = np.random.default_rng(3)
    prior = rng.normal(size=(settings.prior, unit.shape[1]))
    unit = np.vstack([unit, prior / np.linalg.norm(prior, axis=1, keepdims=True)])
    mean = unit.mean(axis=0)
    centred = unit - mean
    _, vectors = np.linalg.eigh(centred.T @ centred)
    axes = vectors[:, ::-1][:, : min(settings.bits, unit.shape[1])]
    projected = centred @ axes
    turn, _ = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))
    for _ in range(settings.rounds):
        left, _, right = np.linalg.svd(np.where(projected @ turn > 0, 1.0, -1.0).T @ projected)
        turn = (left @ right).T
    turns = [turn]
    while sum(t.shape[1] for t in turns) < settings.bits:  # fewer axes than bits: more turns of the same axes
        turns.append(np.linalg.qr(rng.normal(size=turn.shape))[0])
    return Rotation(mean, axes @ np.hstack(turns)[:, : settings.bits])


def _at_cosine(base: np.ndarray, towards: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of ``base`` and, for each, one at the given cosine in the direction of ``towards``."""
    side = towards - (towards * base).sum(axis=1, keepdims=True) * base
    length = np.linalg.norm(side, axis=1, keepdims=True)
    some = length[:, 0] > 1e-6
    return base[some], (cosine * base + np.sqrt(1 - cosine**2) * side / np.maximum(length, 1e-6))[some]


def boundary_pairs(unit: np.ndarray, settings: VectorSettings) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs at the threshold: turned in any direction, turned towards other vectors, and all exact
    pairs of the sample up to 0.02 above it (if there are a hundred or more)."""
    rng = np.random.default_rng(5)
    base = unit[rng.integers(len(unit), size=2000)]
    out = [_at_cosine(base, t, settings.threshold) for t in (rng.normal(size=base.shape), unit[rng.integers(len(unit), size=2000)])]
    left, right = [], []
    for at in range(0, len(unit), 512):
        cosine = unit[at : at + 512] @ unit[at:].T
        i, j = np.nonzero((cosine >= settings.threshold) & (cosine <= settings.threshold + 0.02))
        left.append(at + i[i < j])
        right.append(at + j[i < j])
    i, j = np.concatenate(left), np.concatenate(right)
    some = rng.permutation(len(i))[:5000]
    return [(x, y) for x, y in (*out, (unit[i[some]], unit[j[some]])) if len(x) >= 100]


def substring(code: np.ndarray, part: int, width: int) -> np.ndarray:
    """Bits of table ``part``; they may lie in two neighbouring integers."""
    word, low = divmod(part * width, 64)
    bits = code[:, word] >> np.uint64(low)
    if low + width > 64:
        bits = bits | code[:, word + 1] << np.uint64(64 - low)
    return bits & np.uint64((1 << width) - 1)


def _distance(code: np.ndarray) -> np.ndarray:
    return np.bitwise_count(code).sum(axis=1, dtype=np.int16)


def choose_index(rotation: Rotation, unit: np.ndarray, n: int, settings: VectorSettings) -> Index:
    """The cheapest index over ``n`` vectors that finds the wanted share of every kind of boundary pairs, or
    the one that finds most. Costs are in comparisons of two codes; a pair that goes on to the cosine is
    2000 of them, a row of a table 100. Substrings grow with ``n``, as wide ones meet fewer by chance."""
    rng = np.random.default_rng(6)
    sets = [rotation.codes(x) ^ rotation.codes(y) for x, y in boundary_pairs(unit, settings)]
    base = unit[rng.integers(len(unit), size=2000)]
    half = [_at_cosine(base, t, _half(settings)) for t in (rng.normal(size=base.shape), unit[rng.integers(len(unit), size=2000)])]
    near = max((int(np.quantile(_distance(rotation.codes(x) ^ rotation.codes(y)), 0.99)) for x, y in half if len(x)), default=0)
    codes = rotation.codes(unit)
    some = rng.integers(len(codes), size=(2, 300_000))
    chance = codes[some[0]] ^ codes[some[1]]
    apart, chance_apart = [_distance(d) for d in sets], _distance(chance)
    best, least = Index(8, 8, 8, settings.bits, near), (2.0, float("inf"))
    for width in (6, 8, 10, 12, 14, 16, 20, 24, 28):
        closest = [np.full(len(d), width) for d in sets]
        chance_closest, meetings = np.full(len(chance), width), np.zeros(width + 1)
        for tables in range(1, min(16, settings.bits // width) + 1):
            closest = [np.minimum(c, np.bitwise_count(substring(d, tables - 1, width))) for c, d in zip(closest, sets)]
            bits = np.bitwise_count(substring(chance, tables - 1, width))
            chance_closest = np.minimum(chance_closest, bits)
            meetings += np.bincount(bits, minlength=width + 1).cumsum() / len(chance)
            for flips in range(min(4, width - 1) + 1):
                radius, found = 0, 1.0
                for distance, nearest in zip(apart, closest):
                    met = np.sort(distance[nearest <= flips])
                    wanted = min(ceil(settings.recall * len(distance)), len(met))
                    radius = max(radius, int(met[wanted - 1]) if wanted else 0)
                    found = min(found, wanted / len(distance))
                compared = meetings[flips] + 2000 * np.mean((chance_closest <= flips) & (chance_apart <= radius))
                rows = tables * sum(comb(width, k) * 0.5**k for k in range(flips + 1))
                score = (max(0.0, settings.recall - found), 100 * n * rows + n * n / 2 * compared)
                if score < least:
                    best, least = Index(tables, width, flips, radius, near), score
    return best


def _half(settings: VectorSettings) -> float:
    return cos(acos(settings.threshold) / 2 - 1e-9)


def _unit(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _cosine(a: str, b: str) -> Column:
    """Cosine of two array<double> columns."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


_PARTS = 64  # a bucket's part is its vectors' length times this, plus its table


def _code(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    """The columns ``c0``, ``c1`` … as one row of integers for each vector."""
    names = [c for c in table.schema.names if c[0] == "c" and c[1:].isdigit()]
    return np.stack([table.column(c).to_numpy().view(np.uint64) for c in names], axis=1)


def _keys(codes: DataFrame) -> DataFrame:
    """``part, key`` and the columns of ``codes`` but the length: in every table of the length the code's substring, and
    the substring with up to ``flips`` zeros set. Two substrings that differ in as many bits meet in their union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            length = whole.column("length").to_numpy()
            for one in np.unique(length):
                batch = whole.filter(pa.array(length == one)).drop_columns(["length"])
                index, code = Index.unpacked(batch.column("index")[0].as_py()), _code(batch)
                for part in range(index.tables):
                    own = substring(code, part, index.width)
                    for mask in (sum(1 << b for b in f) for k in range(index.flips + 1) for f in combinations(range(index.width), k)):
                        at = np.flatnonzero((own & np.uint64(mask)) == 0)
                        key = pa.array((own[at] | np.uint64(mask)).view(np.int64))
                        taken = batch.take(pa.array(at))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), one * _PARTS + part, dtype=np.int32)), key, *taken.columns],
                            names=["part", "key", *taken.schema.names],
                        )

    return map_arrow(codes, run, "part int, key long, " + ", ".join(f"{c} long" for c in codes.columns if c != "length"))


def _by_length(table: pa.Table, first: np.ndarray) -> Iterator[tuple[Index, pa.Table, np.ndarray]]:
    """The index, rows and bucket bounds of each length in whole buckets."""
    length = table.column("part").to_numpy() // _PARTS
    for one in np.unique(length):
        low, high = np.searchsorted(length, one, "left"), np.searchsorted(length, one, "right")
        index = Index.unpacked(table.column("index")[int(low)].as_py())
        yield index, table.slice(low, high - low), first[(first >= low) & (first <= high)] - low


def _leaders(codes: DataFrame, settings: VectorSettings) -> DataFrame:
    """``node, leader``: the smallest node met that is likely to be within half the angle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, bounds in whole_buckets(batches):
            for index, table, first in _by_length(whole, bounds):
                code, node = _code(table), table.column("node").to_numpy()
                leader = node.copy()
                for i, j in pairs_within(first):
                    close = _distance(code[i] ^ code[j]) <= index.near
                    np.minimum.at(leader, j[close], node[i[close]])
                    np.minimum.at(leader, i[close], node[j[close]])
                led = leader < node
                yield pa.RecordBatch.from_arrays([pa.array(node[led]), pa.array(leader[led])], names=["node", "leader"])

    met = map_arrow(dealt(_keys(codes), "node", settings.block), run, "node long, leader long")
    return met.groupBy("node").agg(F.min("leader").alias("leader"))


def _candidates(codes: DataFrame, settings: VectorSettings) -> DataFrame:
    """``a, b``: nodes of different cells that meet in a table and differ in ``radius`` bits or less.

    A pair counts in its first table only, and there in the bucket of the union of its substrings.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, bounds in whole_buckets(batches):
            for index, table, first in _by_length(whole, bounds):
                node, cell, part, key, own, i_, j_ = (table.column(c).to_numpy() for c in ("node", "cell", "part", "key", "own", "i", "j"))
                code, part = _code(table), part % _PARTS
                for i, j in pairs_within(first):
                    close = (cell[i] != cell[j]) & ((own[i] != own[j]) | (i_[i] == j_[i]))
                    i, j = i[close], j[close]
                    close = _distance(code[i] ^ code[j]) <= index.radius
                    i, j = i[close], j[close]
                    for t in range(index.tables):
                        x, y = substring(code[i], t, index.width), substring(code[j], t, index.width)
                        meet = np.bitwise_count(x ^ y) <= index.flips  # up to twice as many may share a union
                        earlier = meet & (t < part[i])
                        here = t == part[i]
                        good = ~earlier & (~here | (meet & ((x | y).view(np.int64) == key[i])))
                        i, j = i[good], j[good]
                    yield pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(node[j])], names=["a", "b"])

    return map_arrow(dealt(_keys(codes), "node", settings.block), run, "a long, b long")


def _encoded(distinct: DataFrame, settings: VectorSettings) -> DataFrame:
    """``node, length, index, c0, c1 …`` of every vector that has another of its length.

    A length's model is fitted in one task and goes to the pieces of its vectors as rows do; neither the
    driver nor a broadcast holds models, however many lengths there are.
    """

    def learn(found: pa.Table) -> pa.Table:
        unit = _unit(found.column("embedding").combine_chunks())
        rotation = fit_rotation(unit, settings)
        index = choose_index(rotation, unit, max(settings.planned, found.column("n")[0].as_py()), settings)
        of = {"length": pa.array([unit.shape[1]], pa.int32()), "pieces": found.column("pieces").slice(0, 1)}
        return pa.table(of | {"index": pa.array([index.packed()], pa.int64()), "model": [pickle.dumps(rotation)]})

    def encode(vectors: pa.Table, model: pa.Table) -> pa.Table:
        codes = np.empty((0, settings.bits // 64), dtype=np.uint64)
        if vectors.num_rows:
            codes = pickle.loads(model.column("model")[0].as_py()).codes(_unit(vectors.column("embedding").combine_chunks()))
        index = model.column("index")[0].as_py()
        named = {"node": vectors.column("node"), "length": vectors.column("length"), "index": pa.array(np.full(len(codes), index, dtype=np.int64))}
        return pa.table(named | {f"c{k}": np.ascontiguousarray(codes[:, k]).view(np.int64) for k in range(codes.shape[1])})

    sized = distinct.select("node", "d1", "embedding", F.size("embedding").alias("length"))
    pieces = F.ceil(F.col("n") * F.col("length") / settings.piece).cast("int").alias("pieces")
    lengths = materialize(sized.groupBy("length").agg(F.count("*").alias("n")).where("n > 1").select("length", "n", pieces), "lengths")
    sized = sized.join(lengths, "length")
    share = F.xxhash64("d1", F.lit("sample")) / F.lit(2.0**64) + 0.5  # digests of vectors, which are distinct
    learned = sized.where(share * F.col("n") < settings.sample).select("length", "n", "pieces", "embedding")
    models = materialize(
        learned.groupBy("length").applyInArrow(learn, "length int, pieces int, index long, model binary"), "models"
    ).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    dealt_out = sized.select("node", "length", "embedding", F.pmod(F.xxhash64("d1"), F.col("pieces")).cast("int").alias("piece"))
    longs = ", ".join(f"c{k} long" for k in range(settings.bits // 64))
    ship_package(distinct.sparkSession)
    both = dealt_out.groupBy("length", "piece").cogroup(models.select("length", "piece", "index", "model").groupBy("length", "piece"))
    return materialize(both.applyInArrow(encode, f"node long, length int, index long, {longs}"), "codes")


def near_duplicates(vectors: DataFrame, settings: VectorSettings = VectorSettings(), vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    ``n_links`` counts the other rows with a cosine of ``threshold`` or more (double precision) that the
    index finds, which is fitted to find ``recall`` of those at the threshold; no pair below it counts. ``component_id`` is the smallest vec_id reachable by links.
    Vectors of every length are compared with those of their own length. NULL and zero vectors and
    vectors with NULL or non-finite components link with nothing, as do rows without vec_id (whose
    component is NULL).
    Repeated rows are rows of their own. Only the two named columns are read.
    """
    named = columns_as(vectors, vec_id=vec_id, embedding=embedding).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    digest = [F.xxhash64("embedding").alias("d1"), F.xxhash64("embedding", F.lit(1)).alias("d2")]
    rows = materialize(named.select("vec_id", usable.alias("usable"), *digest), "vectors")
    distinct = materialize(
        named.where(usable).groupBy(*digest).agg(
            F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")
        ),
        "distinct",
    )

    codes = _encoded(distinct, settings)
    whole = distinct.select("node", "embedding")
    other = distinct.select(F.col("node").alias("leader"), F.col("embedding").alias("towards"))
    leaders = materialize(_leaders(codes, settings), "leaders")
    celled = leaders.join(whole, "node").join(other, "leader").where(_cosine("embedding", "towards") >= _half(settings))
    cells = materialize(
        distinct.select("node").join(celled.select("node", "leader"), "node", "left").withColumn("cell", F.coalesce("leader", "node")).drop("leader"),
        "cells",
    )
    pairs = materialize(_candidates(codes.join(cells, "node"), settings), "pairs")
    ends = pairs.join(distinct.select(F.col("node").alias("a"), F.col("embedding").alias("va"), F.col("copies").alias("na")), "a")
    ends = ends.join(distinct.select(F.col("node").alias("b"), F.col("embedding").alias("vb"), F.col("copies").alias("nb")), "b")
    links = materialize(ends.where(_cosine("va", "vb") >= settings.threshold).select("a", "b", "na", "nb"), "links")
    drop_written(codes, leaders, pairs)
    # Links of a row: its copies, the rest of its cell, and the links between cells.
    counted = cells.select("node", "cell").join(distinct.select("node", "copies"), "node")
    in_cell = materialize(counted.groupBy("cell").agg(F.sum("copies").alias("in_cell")), "cell-sizes")
    each = links.select(F.col("a").alias("node"), F.col("nb").alias("n")).unionByName(links.select(F.col("b").alias("node"), F.col("na").alias("n")))
    across = each.groupBy("node").agg(F.sum("n").alias("across"))
    tree = components(links.select("a", "b").unionByName(cells.select(F.col("node").alias("a"), F.col("cell").alias("b"))))
    of_node = (
        distinct.select("d1", "d2", "node")
        .join(materialize(cells.select("node", "cell").join(in_cell, "cell").select("node", "in_cell"), "in-cell"), "node")
        .join(across, "node", "left")
        .join(materialize(tree, "components"), "node", "left")
        .select("d1", "d2", (F.col("in_cell") - 1 + F.coalesce("across", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("head"))
    )
    of_node = materialize(of_node, "nodes")
    found = rows.where("usable").join(of_node, ["d1", "d2"]).select("vec_id", "n_links", F.col("head").alias("component_id"))
    alone = rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
