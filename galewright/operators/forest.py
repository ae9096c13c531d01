"""Random forests by levels on counts.

A split looks at a row's bins only, so rows that agree in label and bins are counted once, and a bootstrap
draws for n such rows a Poisson number of mean n, the sum of what n rows would draw. A pass over the
counted rows adds up, for one level of all trees, the drawn rows of each class by node, feature and bin;
the tasks that sum these choose the splits, and only the splits come to the driver. Most rows soon lie in
leaves: a tree with few counted rows in open nodes is sent these rows and finished by one task. Forests that
differ in their number of trees or depth only are cut from the same trees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galewright.operators.imputing import ModeImputer
from galewright.operators.newton import MOST_FEATURES
from galewright.session import drop_written, materialize, ship_package

# Bins of a number, trees grown together, matrix cells that a task holds at once, the counted rows in
# open nodes up to which one task finishes a tree.
BINS = 32
TOGETHER = 300
CELLS = 8_000_000
FINISHED = 50_000


@dataclass(frozen=True)
class Bins:
    """Features of rows as small integers: 0/1 for each category met in fitting, the quantile's number for numbers.

    A missing category counts as the most frequent one, a missing number as the mean, an unknown category as none.
    """

    categories: tuple[tuple[str, str | None, tuple[str, ...]], ...]
    edges: tuple[tuple[str, float, tuple[float, ...]], ...]

    @staticmethod
    def fitted(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> Bins:
        categories, edges = [], []
        if categorical:
            texts = df.select(*[F.col(c).cast("string").alias(c) for c in categorical])
            modes = ModeImputer(inputCols=list(categorical)).fit(texts)
            fills = dict(zip(modes.getOrDefault(modes.filled), modes.getOrDefault(modes.fills)))
            pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in categorical])
            met = texts.select(F.inline(pairs)).where("v IS NOT NULL").distinct().limit(MOST_FEATURES + 1).collect()
            if len(met) > MOST_FEATURES:
                raise ValueError(f"more than {MOST_FEATURES} features")
            categories = [(c, fills.get(c), tuple(sorted(r["v"] for r in met if r["c"] == c))) for c in categorical]
        if numeric:
            doubles = df.select(*[F.col(c).cast("double").alias(c) for c in numeric])
            means = doubles.agg(*[F.avg(c).alias(c) for c in numeric]).first()
            cuts = doubles.approxQuantile(list(numeric), [i / BINS for i in range(1, BINS)], 0.001)
            edges = [(c, means[c] or 0.0, tuple(sorted(set(q)))) for c, q in zip(numeric, cuts)]
        return Bins(tuple(categories), tuple(edges))

    def columns(self) -> list[Column]:
        """``c0, c1, …``: a category's number, -1 if unknown; then a number's bin, how many edges lie below it."""
        found = []
        for c, fill, values in self.categories:
            value = F.coalesce(F.col(c).cast("string"), F.lit(fill).cast("string"))
            code = F.lit(-1)
            for i, v in enumerate(values):
                code = F.when(value == v, i).otherwise(code)
            found.append(code)
        for c, mean, cuts in self.edges:
            value = F.coalesce(F.col(c).cast("double"), F.lit(float(mean)))
            found.append(sum(((value > e).cast("int") for e in cuts), F.lit(0)))
        return [c.cast("int").alias(f"c{i}") for i, c in enumerate(found)]

    @property
    def size(self) -> int:
        return sum(len(v) for _, _, v in self.categories) + len(self.edges)

    def matrix(self, codes: Sequence[np.ndarray]) -> np.ndarray:
        """Rows by features, one byte each."""
        wide = [codes[i] == k for i, (_, _, values) in enumerate(self.categories) for k in range(len(values))]
        wide += list(codes[len(self.categories) :])
        return np.column_stack([w.astype(np.uint8) for w in wide])


@dataclass
class Tree:
    """Nodes by number: the feature (-1: a leaf), the last bin that goes left, the left child, and class 1's share.

    Numbers run level by level; ``ends`` has the number of nodes down to each level.
    """

    feature: np.ndarray = field(default_factory=lambda: np.full(1, -1, np.int32))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int32))
    left: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int32))
    share: np.ndarray = field(default_factory=lambda: np.zeros(1))
    open: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int32))
    ends: list[int] = field(default_factory=lambda: [1])

    def until(self, depth: int) -> Tree:
        """The tree as it was at this depth."""
        if depth >= len(self.ends) - 1:
            return self
        end = self.ends[depth]
        feature = self.feature[:end].copy()
        feature[self.ends[depth - 1] if depth else 0 :] = -1
        return Tree(feature, self.cut[:end], self.left[:end], self.share[:end], self.open[:0], self.ends[: depth + 1])

    def _steps(self, stay: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature, cut and left child by node, such that rows in the nodes given stay there."""
        feature, cut = np.where(stay, 0, self.feature).astype(np.intp), np.where(stay, 255, self.cut).astype(np.uint8)
        return feature, cut, np.where(stay, np.arange(len(stay)), self.left).astype(np.intp)

    def leaves(self, matrix: np.ndarray) -> np.ndarray:
        """The leaf that each row reaches."""
        flat, width = matrix.ravel(), matrix.shape[1]
        feature, cut, left = self._steps(self.feature < 0)
        found = np.zeros(len(matrix), np.intp)
        rows, base, node = np.arange(len(matrix)), np.arange(len(matrix)) * width, np.zeros(len(matrix), np.intp)
        for step in range(1, len(self.ends)):
            node = left.take(node) + (flat.take(base + feature.take(node)) > cut.take(node))
            if step % 4 == 0:
                found[rows] = node
                inner = np.flatnonzero(self.feature.take(node) >= 0)
                rows, base, node = rows.take(inner), base.take(inner), node.take(inner)
        found[rows] = node
        return found

    def reached(self, matrix: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows that lie in open nodes, and the place of each one's node among these."""
        flat, width = matrix.ravel(), matrix.shape[1]
        leads = np.zeros(len(self.feature), bool)  # to an open node; the others' rows are dropped where they enter
        leads[self.open] = True
        for first, end in reversed(list(zip([0, *self.ends], self.ends[:-1]))):
            inner = first + np.flatnonzero(self.feature[first:end] >= 0)
            leads[inner] = leads[self.left[inner]] | leads[self.left[inner] + 1]
        feature, cut, left = self._steps(~leads | (self.feature < 0))
        base, node = rows * width, np.zeros(len(rows), np.intp)
        for _ in self.ends[1:]:
            node = left.take(node) + (flat.take(base + feature.take(node)) > cut.take(node))
            kept = np.flatnonzero(leads.take(node))
            if len(kept) < 0.9 * len(node):
                rows, base, node = rows.take(kept), base.take(kept), node.take(kept)
        kept = np.flatnonzero(leads.take(node))
        place = np.zeros(len(self.feature), np.intp)
        place[self.open] = np.arange(len(self.open))
        return rows.take(kept), place.take(node.take(kept))

    def grow(self, splits: np.ndarray, weights: Sequence[float], last: bool) -> None:
        """Split the open nodes by rows of (feature, cut, class counts, class counts on the left)."""

        def share(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
            return ones * weights[1] / np.maximum(zeros * weights[0] + ones * weights[1], 1e-300)

        if len(self.feature) == 1:
            self.share = share(splits[:, 2], splits[:, 3])
        at, found = self.open[splits[:, 0] >= 0], splits[splits[:, 0] >= 0]
        first = len(self.feature) + 2 * np.arange(len(at), dtype=np.int32)
        self.feature[at], self.cut[at], self.left[at] = found[:, 0], found[:, 1], first
        zeros = np.column_stack([found[:, 4], found[:, 2] - found[:, 4]]).ravel()
        ones = np.column_stack([found[:, 5], found[:, 3] - found[:, 5]]).ravel()
        new = np.arange(len(self.feature), len(self.feature) + 2 * len(at), dtype=np.int32)
        self.feature = np.concatenate([self.feature, np.full(len(new), -1, np.int32)])
        self.cut, self.left = (np.concatenate([a, np.zeros(len(new), np.int32)]) for a in (self.cut, self.left))
        self.share = np.concatenate([self.share, share(zeros, ones)])
        self.open = new[(zeros > 0) & (ones > 0)] if not last else new[:0]
        self.ends = [*self.ends, len(self.feature)]


@dataclass(frozen=True)
class Forest:
    """Fitted trees; the score is the mean of their leaves' shares of class 1."""

    bins: Bins
    trees: list[Tree]

    def score(self, spark: SparkSession, codes: Sequence[Column]) -> Column:
        """The class-1 score of rows by their bins, in Arrow batches."""
        bins, sent = self.bins, spark.sparkContext.broadcast(self.trees)

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in batches:
                matrix = bins.matrix([batch[c].to_numpy() for c in batch.columns])
                total = np.zeros(len(batch))
                for tree in sent.value:
                    total += tree.share.take(tree.leaves(matrix))
                yield pd.Series(total / len(sent.value))

        ship_package(spark)
        return score(F.struct(*codes))

    def apply(self, df: DataFrame) -> DataFrame:
        """Add the class-1 ``score`` and ``prediction`` (double)."""
        scored = df.withColumn("score", self.score(df.sparkSession, self.bins.columns()))
        return scored.withColumn("prediction", (F.col("score") > 0.5).cast("double"))

    def counted_predictions(self, counted: DataFrame) -> DataFrame:
        """``(y, score, prediction)`` of every row that ``counted_rows`` has counted; equal rows are scored once."""
        codes = [F.col(c) for c in counted.columns if c[0] == "c"]
        scored = counted.select("y", "n", self.score(counted.sparkSession, codes).alias("score"))
        every = scored.select("y", "score", F.explode(F.array_repeat(F.lit(True), F.col("n").cast("int")))).drop("col")
        return every.withColumn("prediction", (F.col("score") > 0.5).cast("int"))


def counted_rows(df: DataFrame, bins: Bins, label: str) -> DataFrame:
    """``id, y, n, c0, c1, …``: the rows with a 0/1 label, counted by label and bins, written in even parts."""
    spark, codes = df.sparkSession, bins.columns()
    names = [f"c{i}" for i in range(len(codes))]
    labelled = df.where(F.col(label).isNotNull()).select(F.col(label).cast("int").alias("y"), *codes)
    groups = materialize(labelled.groupBy("y", *names).agg(F.count(F.lit(1)).alias("n")), "groups")
    parts = max(spark.sparkContext.defaultParallelism, -(-groups.count() // 1_000_000))
    dealt = groups.repartition(parts).select(F.monotonically_increasing_id().alias("id"), "y", "n", *names)
    written = materialize(dealt, "counted")
    drop_written(groups)
    return written


def _subsets(seed: int, tree: int, level: int, nodes: int, size: int) -> np.ndarray:
    """The features that each open node of a level may split on: the square root of their number."""
    draws = np.random.default_rng([seed, tree, level]).random((nodes, size))
    return np.argsort(draws, axis=1)[:, : math.ceil(math.sqrt(size))].astype(np.int32)


def _best_splits(counts: np.ndarray, subsets: np.ndarray, weights: Sequence[float], leaf: int) -> np.ndarray:
    """By node: feature, last bin on the left, class counts, class counts on the left; of the largest Gini gain."""
    left = counts.cumsum(axis=2)  # node, feature, bin, class
    total = left[:, :1, -1:, :]
    right = total - left

    def impure(c: np.ndarray) -> np.ndarray:
        zeros, ones = c[..., 0] * weights[0], c[..., 1] * weights[1]
        return 2 * zeros * ones / np.maximum(zeros + ones, 1e-300)

    gain = impure(total) - impure(left) - impure(right)
    gain[(left.sum(axis=3) < max(leaf, 1)) | (right.sum(axis=3) < max(leaf, 1))] = -1.0
    best = gain.reshape(len(gain), -1).argmax(axis=1)
    at, (which, cut) = np.arange(len(gain)), np.divmod(best, BINS)
    feature = np.where(gain[at, which, cut] > 1e-9, subsets[at, which], -1)
    return np.column_stack([feature, cut, total[:, 0, 0], left[at, which, cut]]).astype(np.int64)


def _counts(matrix: np.ndarray, y: np.ndarray, drawn: np.ndarray, at: np.ndarray, place: np.ndarray, subset: np.ndarray) -> np.ndarray:
    """The drawn rows, given by number and node, by node, feature of its subset, bin and class; trailing zeros left out."""
    width = subset.shape[1]
    features = matrix.ravel().take(at[:, None] * matrix.shape[1] + subset.take(place, axis=0))
    cell = features + BINS * (np.arange(width) + width * place[:, None])
    index = (2 * cell + y.take(at)[:, None]).ravel()
    return np.bincount(index, weights=np.repeat(drawn.take(at), width), minlength=1)


def _splits(sums: np.ndarray, subset: np.ndarray, weights: Sequence[float], leaf: int) -> np.ndarray:
    counts, some = sums.reshape(*subset.shape, BINS, 2), range(0, len(subset), 2048)
    return np.concatenate([_best_splits(counts[i : i + 2048], subset[i : i + 2048], weights, leaf) for i in some])


def _finished(growing: Growing, matrix: np.ndarray, drawn: np.ndarray, place: np.ndarray, weights: Sequence[float], seed: int) -> Iterator[np.ndarray]:
    """The splits of each further level of a tree, from all its rows in open nodes; the matrix ends in the label."""
    matrix, y, tree = np.ascontiguousarray(matrix[:, :-1]), matrix[:, -1].astype(np.int64), Tree(**vars(growing.tree))
    tree.feature, tree.cut, tree.left = tree.feature.copy(), tree.cut.copy(), tree.left.copy()
    at = np.arange(len(y))
    for level in range(len(tree.ends) - 1, growing.depth):
        subset = _subsets(seed, growing.number, level, len(tree.open), matrix.shape[1])
        total, sums = np.zeros(subset.size * BINS * 2), _counts(matrix, y, drawn, at, place, subset)
        total[: len(sums)] = sums
        splits = _splits(total, subset, weights, growing.leaf)
        yield splits
        node = tree.open.take(place)
        tree.grow(splits, weights, last=level == growing.depth - 1)
        if not len(tree.open):
            return
        split = np.flatnonzero(tree.feature.take(node) >= 0)
        at, node = at.take(split), node.take(split)
        node = tree.left.take(node) + (matrix[at, tree.feature.take(node)] > tree.cut.take(node))
        places = np.full(len(tree.feature), -1, np.intp)
        places[tree.open] = np.arange(len(tree.open))
        place = places.take(node)
        at, place = at[place >= 0], place[place >= 0]


@dataclass
class Growing:
    """A tree, its number (which decides its draws), the fewest rows of a leaf, its depth, and about how many counted rows
    lie in open nodes."""

    tree: Tree
    number: int
    leaf: int
    depth: int
    rows: int

    def grow(self, found: int, splits: Sequence[np.ndarray], weights: Sequence[float]) -> None:
        """Grow by the splits of a level, or of all further ones; its rows are taken to stay open as its drawn rows do."""
        for each in splits:
            self.tree.grow(each, weights, last=len(self.tree.ends) == self.depth)
        halves = np.stack([splits[0][:, 4:6], splits[0][:, 2:4] - splits[0][:, 4:6]])
        still = halves[(halves > 0).all(axis=2) & (splits[0][:, 0] >= 0)].sum()
        self.rows = int(found * still / max(splits[0][:, 2:4].sum(), 1))


def _level(rows: DataFrame, bins: Bins, trees: dict[int, Growing], weights: Sequence[float], seed: int) -> dict[int, tuple[int, list[np.ndarray]]]:
    """By tree: its counted rows in open nodes and the splits of these nodes, from one pass over the counted rows.

    A task sends the counts that are not zero, so no more than its rows times the features of a node. For a tree
    with at most ``FINISHED`` rows in open nodes it sends these rows, and the splits of all further levels come back.
    """
    spark, size = rows.sparkSession, bins.size
    sent, most = spark.sparkContext.broadcast(trees), FINISHED

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n * size >= CELLS:
                yield pa.Table.from_batches(held)
                held, n = [], 0
        if n:
            yield pa.Table.from_batches(held)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            first, y, n, *codes = (c.to_numpy() for c in block.columns)
            matrix, y = bins.matrix(codes), y.astype(np.int64)
            for key, growing in sent.value.items():
                drawn = np.random.default_rng([seed, growing.number, int(first[0])]).poisson(n)
                at, place = growing.tree.reached(matrix, np.flatnonzero(drawn))
                if growing.rows <= most:
                    features = np.column_stack([matrix[at], y.take(at).astype(np.uint8)]).tobytes()
                    where, counts = place, drawn.take(at)
                else:
                    subset = _subsets(seed, growing.number, len(growing.tree.ends) - 1, len(growing.tree.open), size)
                    sums, features = _counts(matrix, y, drawn, at, place, subset), b""
                    where = np.flatnonzero(sums)
                    counts = sums.take(where)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key]), pa.array([len(at)]), *(pa.array([v.astype(np.int32).tobytes()], pa.binary()) for v in (where, counts)), pa.array([features], pa.binary())],
                    names=["tree", "rows", "at", "n", "features"],
                )

    def choose(table: pa.Table) -> pa.Table:
        key = table.column("tree")[0].as_py()
        growing, found = sent.value[key], sum(table.column("rows").to_pylist())
        pairs = [[np.frombuffer(v, np.int32) for v in table.column(c).to_pylist()] for c in ("at", "n")]
        if growing.rows <= most:
            features = np.frombuffer(b"".join(table.column("features").to_pylist()), np.uint8).reshape(-1, size + 1)
            place, drawn = (np.concatenate(p) for p in pairs)
            splits = list(_finished(growing, features, drawn, place, weights, seed))
        else:
            subset = _subsets(seed, growing.number, len(growing.tree.ends) - 1, len(growing.tree.open), size)
            total = np.zeros(subset.size * BINS * 2)
            for at, n in zip(*pairs):
                total[at] += n
            splits = [_splits(total, subset, weights, growing.leaf)]
        return pa.table({"tree": [key], "rows": [found], "splits": pa.array([[s.tobytes() for s in splits]], pa.list_(pa.binary()))})

    ship_package(spark)
    counts = rows.mapInArrow(count, "tree long, rows long, at binary, n binary, features binary")
    dealt = counts.repartition(spark.sparkContext.defaultParallelism, "tree")
    found = dealt.groupBy("tree").applyInArrow(choose, "tree long, rows long, splits array<binary>").collect()
    sent.unpersist()
    return {r["tree"]: (r["rows"], [np.frombuffer(s, np.int64).reshape(-1, 6) for s in r["splits"]]) for r in found}


def fit_many(rows: DataFrame, bins: Bins, wanted: Sequence[dict[str, int]], seed: int = 42, parallelism: int = 3) -> list[Forest]:
    """A forest for each of ``trees``, ``depth`` and ``leaf``, as ``fit_counted`` fits it, all from the same passes.

    A tree follows from its number and ``leaf``, and a shallower one is its upper part, so it is grown once.
    """
    sums = {r["y"]: (r["n"], r["rows"]) for r in rows.groupBy("y").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")).collect()}
    if not set(sums) <= {0, 1}:
        raise ValueError(f"a label that is not 0 or 1 among {sorted(sums)}")
    every, counted = (sum(s[i] for s in sums.values()) for i in (0, 1))
    weights = [every / (len(sums) * sums[k][0]) if k in sums else 0.0 for k in (0, 1)]
    deepest: dict[tuple[int, int], int] = {}
    for w in wanted:
        for number in range(w["trees"]):
            deepest[w["leaf"], number] = max(w["depth"], deepest.get((w["leaf"], number), 0))
    grown = {key: Growing(Tree(), key[1], key[0], depth, counted) for key, depth in deepest.items()}

    def grow(group: list[Growing]) -> None:
        while growing := {i: g for i, g in enumerate(group) if len(g.tree.open) and len(g.tree.ends) <= g.depth}:
            found = _level(rows, bins, growing, weights, seed)
            if not found:  # no rows
                return
            for i, (left, splits) in found.items():
                growing[i].grow(left, splits, weights)

    alike = sorted(grown.values(), key=lambda g: (g.depth, g.leaf, g.number))
    with ThreadPool(parallelism) as pool:
        pool.map(grow, [alike[i : i + TOGETHER] for i in range(0, len(alike), TOGETHER)], chunksize=1)
    return [Forest(bins, [grown[w["leaf"], number].tree.until(w["depth"]) for number in range(w["trees"])]) for w in wanted]


def fit_counted(rows: DataFrame, bins: Bins, trees: int = 100, depth: int = 10, leaf: int = 1, seed: int = 42) -> Forest:
    """A forest with balanced class weights from ``counted_rows``: bootstrapped rows, Gini, sqrt of the features a node."""
    return fit_many(rows, bins, [{"trees": trees, "depth": depth, "leaf": leaf}], seed)[0]


def fit_forest(
    train: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str], trees: int = 100, depth: int = 10, leaf: int = 1, seed: int = 42
) -> Forest:
    bins = Bins.fitted(train, categorical, numeric)
    return fit_counted(counted_rows(train, bins, label), bins, trees, depth, leaf, seed)
