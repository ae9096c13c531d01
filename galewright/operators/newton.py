"""Logistic regression by Newton steps on sums.

A pass over the rows gives, for any number of models together, the gradient X'W(p - y), the curvature
X'W diag(p (1 - p)) X and the loss; a small solve on the driver gives the next coefficients. The optimum is
unique, and a certificate comes with it: at the optimum the score equations hold, so the weighted sum of
each feature over the fitted probabilities, plus the penalty's part, equals that over the labels.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewright.functions.numeric import ratio
from galewright.session import drop_written, materialize, ship_package

#: A model's curvature has the square of this many numbers, on the driver and in one row of a task.
MOST_FEATURES = 2000
#: Numbers of the design that a block of rows holds.
BLOCK = 65_536
#: 0/1 features that a number of 64 bits holds.
BITS = 62
INTERCEPT = "(intercept)"


@dataclass(frozen=True)
class Design:
    """Features of rows: 0/1 for each category met in fitting, and numbers less their mean over their deviation."""

    categories: tuple[tuple[str, str], ...]
    moments: tuple[tuple[str, float, float], ...]

    @staticmethod
    def fitted(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> Design:
        """One aggregation for the numbers, one for the categories. A constant number is only centred."""
        moments = []
        if numeric:
            row = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in numeric for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
            moments = [(c, row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in numeric]
        found: list[tuple[str, str]] = []
        if categorical:
            pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in categorical])
            met = df.select(F.inline(pairs)).where("v IS NOT NULL").distinct().limit(MOST_FEATURES + 1).collect()
            found = sorted((r["c"], r["v"]) for r in met)
        if len(found) + len(moments) >= MOST_FEATURES:
            raise ValueError(f"more than {MOST_FEATURES} features")
        return Design(tuple(found), tuple(moments))

    @property
    def names(self) -> list[str]:
        return [INTERCEPT, *(f"{c}={v}" for c, v in self.categories), *(c for c, _, _ in self.moments)]

    def columns(self) -> list[Column]:
        """One column a feature, but for the intercept. A missing number counts as the mean, an unknown category as none."""
        ones = [F.coalesce((F.col(c).cast("string") == v).cast("double"), F.lit(0.0)) for c, v in self.categories]
        return ones + [F.coalesce((F.col(c).cast("double") - F.lit(m)) / F.lit(s), F.lit(0.0)) for c, m, s in self.moments]


@dataclass(frozen=True)
class Logistic:
    """Coefficients in the design's order, the passes taken, and the certificate's largest gap."""

    design: Design
    coefficients: np.ndarray
    passes: int
    gap: float

    def score(self) -> Column:
        """The probability of class 1 as an expression."""
        logit = F.lit(float(self.coefficients[0]))
        for value, column in zip(self.coefficients[1:], self.design.columns()):
            logit = logit + F.lit(float(value)) * column
        return 1 / (1 + F.exp(-logit))

    def apply(self, df: DataFrame) -> DataFrame:
        """Add the class-1 ``score`` and ``prediction`` (double). No Python: the model is a sum of columns."""
        return df.withColumn("score", self.score()).withColumn("prediction", (F.col("score") >= 0.5).cast("double"))


def balanced_weight(df: DataFrame, label: str) -> DataFrame:
    """The rows with a 0/1 label as ``_y`` and weight ``_w``: rows / (2 · rows of the class), from one small aggregate."""
    y = F.col(label).cast("double")
    counts = df.agg(F.struct(F.count(y).alias("n"), F.sum(y).alias("ones")).alias("c")).scalar()
    n, ones = counts.getField("n"), counts.getField("ones")
    weight = F.when(y == 1, ratio(n, 2 * ones)).otherwise(ratio(n, 2 * (n - ones)))
    return df.where(y.isNotNull()).withColumns({"_y": y, "_w": weight})


def design_rows(df: DataFrame, design: Design, label: str) -> DataFrame:
    """``y, w, x0, x1, …``: computed from the rows whenever read; a fit writes them once, in blocks."""
    named = [c.alias(f"x{i}") for i, c in enumerate(design.columns())]
    return balanced_weight(df, label).select(F.col("_y").alias("y"), F.col("_w").alias("w"), *named)


def _blocks(rows: DataFrame, design: Design) -> DataFrame:
    """``n, ones, numbers``: the rows of ``design_rows`` in blocks, 0/1 features as bits, ``y``, ``w`` and numbers as doubles.

    Every pass reads all rows again, and to hand a task's rows over one number at a time takes far longer than the
    sums. Small row groups, as a task holds one while it reads.
    """
    ones, size = len(design.categories), max(BLOCK // len(design.names), 1)
    starts = range(0, ones, BITS)

    def bits(start: int) -> Column:
        flags = [F.col(f"x{i}").cast("long") * F.lit(1 << i - start) for i in range(start, min(start + BITS, ones))]
        return sum(flags, F.lit(0).cast("long")).alias(f"b{start}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            flags = np.column_stack([np.zeros((batch.num_rows, 0), np.int64), *columns[: len(starts)]])
            numbers = np.column_stack(columns[len(starts) :])
            for i in range(0, batch.num_rows, size):
                some = [pa.array([v[i : i + size].tobytes()], pa.binary()) for v in (flags, numbers)]
                yield pa.RecordBatch.from_arrays([pa.array([len(numbers[i : i + size])]), *some], names=["n", "ones", "numbers"])

    ship_package(rows.sparkSession)
    numbers = [f"x{i}" for i in range(ones, len(design.names) - 1)]
    packed = rows.select(*[bits(i) for i in starts], "y", "w", *numbers).mapInArrow(run, "n long, ones binary, numbers binary")
    return materialize(packed, "blocks", **{"parquet.block.size": 16 << 20})


def _unpacked(rows: int, flags: bytes, numbers: bytes, ones: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's matrix of features, and its ``y`` and ``w`` as columns."""
    found = np.frombuffer(numbers).reshape(rows, -1)
    bits = np.frombuffer(flags, np.uint8).reshape(rows, -1, 8)
    wide = [np.unpackbits(bits[:, i], axis=1, count=min(BITS, ones - i * BITS), bitorder="little") for i in range(bits.shape[1])]
    return np.column_stack([np.ones(rows), *wide, found[:, 2:]]), found[:, :1], found[:, 1:2]


def _sums(blocks: DataFrame, models: np.ndarray, ones: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, gradient and curvature of every model's coefficients over all rows.

    Each task sends its sums by model and row of the matrix, and they are added up by those, so no task and
    not the driver ever holds the sums of all tasks.
    """
    n, d = models.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, gradient, curvature = np.zeros(n), np.zeros((n, d)), np.zeros((n, d, d))
        for block in (block for batch in batches for block in zip(*(c.to_pylist() for c in batch.columns))):
            matrix, y, w = _unpacked(*block, ones)
            z = matrix @ models.T
            e = np.exp(-np.abs(z))
            p = np.where(z >= 0, 1.0, e) / (1 + e)
            loss += (w * (np.log1p(e) + np.maximum(z, 0) - y * z)).sum(axis=0)
            gradient += (w * (p - y)).T @ matrix
            spread = w * e / (1 + e) ** 2
            for k in range(n):
                curvature[k] += (matrix * spread[:, k : k + 1]).T @ matrix
        both = np.concatenate([curvature, gradient[:, :, None], np.broadcast_to(loss[:, None, None], (n, d, 1))], axis=2)
        at = np.arange(n * d)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(list(both.reshape(n * d, d + 2)))], names=["at", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum(np.stack(table.column("sums").to_pylist()), axis=0)
        return pa.table({"at": [table.column("at")[0].as_py()], "sums": [total.tolist()]})

    schema = "at long, sums array<double>"
    found = blocks.mapInArrow(run, schema).groupBy("at").applyInArrow(add, schema).collect()
    total = np.zeros((n * d, d + 2))
    for row in found:
        total[row["at"]] = row["sums"]
    total = total.reshape(n, d, d + 2)
    return total[:, 0, -1], total[:, :, -2], total[:, :, :-2]


def fit_many(rows: DataFrame, design: Design, strengths: Sequence[float], most: int = 40, tolerance: float = 1e-9) -> list[Logistic]:
    """A model for each inverse penalty strength C, all in shared passes.

    Minimises the weighted log loss + (squared coefficients without intercept) / (2 C). A step that doesn't
    lower the loss is halved. A model is ready when no score equation is off by more than ``tolerance`` times
    the rows, and the others go on without it; fails after ``most`` passes.
    """
    d, n = len(design.names), len(strengths)
    blocks = _blocks(rows, design)
    count = blocks.agg(F.sum("n")).first()[0] or 0
    penalty = np.ones((n, d)) / np.asarray(strengths, dtype=float)[:, None]
    penalty[:, 0] = 0.0
    best, tried = np.zeros((n, d)), np.zeros((n, d))
    least, step = np.full(n, np.inf), np.zeros((n, d))
    gap, passes, going = np.full(n, np.inf), np.zeros(n, int), np.arange(n)
    while len(going) and passes.max() < most:
        loss, gradient, curvature = _sums(blocks, tried[going], len(design.categories))
        passes[going] += 1
        loss = loss + (penalty[going] * tried[going] ** 2).sum(axis=1) / 2
        for i, k in enumerate(going):
            # Equal but for rounding counts as lower: near the optimum the loss no longer tells.
            if loss[i] <= least[k] + 1e-12 * abs(loss[i]):
                slope = gradient[i] + penalty[k] * tried[k]
                best[k], least[k], gap[k] = tried[k], loss[i], np.abs(slope).max()
                step[k] = -np.linalg.lstsq(curvature[i] + np.diag(penalty[k]), slope, rcond=None)[0]
            else:
                step[k] /= 2
        tried = best + step
        going = np.flatnonzero(gap > tolerance * max(count, 1))
    if len(going):
        raise ValueError(f"no optimum after {most} passes")
    drop_written(blocks)
    return [Logistic(design, best[k], int(passes[k]), float(gap[k])) for k in range(n)]


def fit_logistic(train: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str], c: float = 1.0) -> Logistic:
    """L2 logistic regression with balanced weights."""
    design = Design.fitted(train, categorical, numeric)
    return fit_many(design_rows(train, design, label), design, [c])[0]


def score_equations(model: Logistic, rows: DataFrame, c: float) -> DataFrame:
    """``(feature, fitted)``: each feature's weighted sum over the fitted probabilities, plus the penalty's part.

    At the optimum these equal the weighted sums over the labels, which needs no model to compute.
    """
    beta = [float(v) for v in model.coefficients]
    x = [F.lit(1.0), *[F.col(f"x{i}") for i in range(len(beta) - 1)]]
    logit = sum((F.lit(b) * v for b, v in zip(beta[1:], x[1:])), F.lit(beta[0]))
    p = 1 / (1 + F.exp(-logit))
    sums = [F.sum(F.col("w") * p * v) + F.lit(0.0 if i == 0 else beta[i] / c) for i, v in enumerate(x)]
    wide = rows.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)])
    cells = [F.struct(F.lit(n).alias("feature"), F.col(f"s{i}").alias("fitted")) for i, n in enumerate(model.design.names)]
    return wide.select(F.inline(F.array(*cells)))
