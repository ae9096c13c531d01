"""Training, tuning and evaluation with ``pyspark.ml``."""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galewright.operators import forest as forest_, newton
from galewright.operators.imputing import ModeImputer
from galewright.operators.metrics import all_metrics, averaged_metrics, metric_rows, roc_auc
from galewright.operators.prepare import with_class_weight
from galewright.session import materialize

WEIGHT = "class_weight"
LOGISTIC = "LogisticRegression"
QUALITY = ("accuracy", "precision", "recall", "f1", "weighted_precision", "weighted_recall", "weighted_f1", "macro_f1")


def preprocessing(categorical: Sequence[str], numeric: Sequence[str]) -> list:
    """Fill, index and one-hot the categories, with a slot for unknown ones; fill and scale the numbers."""
    stages: list = []
    parts: list[str] = []
    if categorical:
        indexed = [f"{c}_index" for c in categorical]
        encoded = [f"{c}_onehot" for c in categorical]
        stages.append(ModeImputer(inputCols=list(categorical)))
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=False))
        parts += encoded
    if numeric:
        imputed = [f"{c}_filled" for c in numeric]
        stages.append(Imputer(inputCols=list(numeric), outputCols=imputed, strategy="mean"))
        stages.append(VectorAssembler(inputCols=imputed, outputCol="numbers"))
        stages.append(StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True))
        parts.append("scaled")
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return stages


def logistic(label: str, rows: int, c: float = 1.0, tol: float = 1e-4, max_iter: int = 1000) -> LogisticRegression:
    """L2 logistic regression with balanced weights; inverse strength ``c`` counts rows, Spark's penalty does not."""
    return LogisticRegression(
        labelCol=label, weightCol=WEIGHT, regParam=1.0 / (c * max(rows, 1)), elasticNetParam=0.0,
        tol=tol, maxIter=max_iter, standardization=False,
    )


def forest(label: str, trees: int = 100, depth: int = 10, leaf: int = 1, seed: int = 42, memory_mb: int = 1024) -> RandomForestClassifier:
    """``memory_mb`` for split statistics: the more fits, the more nodes are split in one pass over the rows."""
    return RandomForestClassifier(
        labelCol=label, weightCol=WEIGHT, numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, seed=seed, maxMemoryInMB=memory_mb
    )


def numeric_inputs(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Cast the numeric inputs to double, which imputation needs."""
    return df.withColumns({c: F.col(c).cast("double") for c in numeric})


def fit_model(
    train: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str], classifier: Estimator
) -> PipelineModel:
    """Fit preprocessing and classifier on balanced training rows."""
    weighted = with_class_weight(numeric_inputs(train, numeric), label)
    prepared = Pipeline(stages=preprocessing(categorical, numeric)).fit(weighted)
    model = classifier.fit(dealt(prepared.transform(weighted).select("features", label, WEIGHT)))
    return PipelineModel([*prepared.stages, model])


def dealt(rows: DataFrame, most: int = 1_000_000) -> DataFrame:
    """The rows dealt evenly to all cores, in parts of at most ``most`` rows.

    A forest takes far more time a byte than Spark reckons with, so by size its rows would go to a few tasks. As
    every task sends the statistics of all nodes, there are no more parts than needed.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(cores, -(-rows.count() // most)))


def apply_model(model: Model, df: DataFrame, numeric: Sequence[str] = ()) -> DataFrame:
    """Add ``prediction`` (double) and the class-1 ``score``."""
    scored = model.transform(numeric_inputs(df, numeric))
    return scored.withColumn("score", vector_to_array("probability")[1])


def evaluate(predicted: DataFrame, label: str, prefix: str = "", prediction: str = "prediction", score: str = "score") -> DataFrame:
    """(metric, value) rows of all quality metrics of scored rows, names prefixed.

    The three needed columns are written once, so that the model scores each row once.
    """
    slim = predicted.select(
        F.col(label).cast("int").alias(label), F.col(prediction).cast("int").alias(prediction), F.col(score).alias(score)
    )
    rows = materialize(slim, "evaluate")
    quality = metric_rows(all_metrics(rows, label, prediction), [], QUALITY)
    area = metric_rows(roc_auc(rows, label, score), [], ["roc_auc"])
    named = quality.unionByName(area)
    return named.select(F.concat(F.lit(prefix), F.col("metric")).alias("metric"), "value")


@dataclass(frozen=True)
class Trial:
    """One point of the search: a classifier name and its parameters."""

    number: int
    classifier: str
    params: dict[str, float] = field(default_factory=dict)

    def estimator(self, label: str, rows: int, seed: int) -> Estimator:
        p = self.params
        if self.classifier == LOGISTIC:
            return logistic(label, rows, c=p["C"], tol=p["tol"])  # for a pipeline; the search fits these together
        return forest(label, trees=int(p["trees"]), depth=int(p["depth"]), leaf=int(p["leaf"]), seed=seed)


# Search ranges (low, high, log scale).
LOGISTIC_RANGES = {"C": (1e-2, 10.0, True), "tol": (1e-6, 1e-3, True)}
FOREST_RANGES = {"depth": (3, 15, False), "trees": (50, 300, False), "leaf": (1, 10, False)}


def draw_trials(n: int = 20, seed: int = 42, forest_ranges: dict | None = None) -> list[Trial]:
    """A seeded random search over both classifiers."""
    rng = random.Random(seed)
    trials = []
    for number in range(n):
        name = rng.choice([LOGISTIC, "RandomForest"])
        ranges = LOGISTIC_RANGES if name == LOGISTIC else (forest_ranges or FOREST_RANGES)
        params: dict[str, float] = {}
        for key, (low, high, log) in ranges.items():
            if log:
                params[key] = float(low * (high / low) ** rng.random())
            elif isinstance(low, int):
                params[key] = rng.randint(low, high)
            else:
                params[key] = rng.uniform(low, high)
        trials.append(Trial(number, name, params))
    return trials


@dataclass(frozen=True)
class TuningResult:
    best: Trial
    table: DataFrame


def tune(
    train: DataFrame,
    validation: DataFrame,
    label: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    trials: Sequence[Trial],
    seed: int = 42,
    parallelism: int = 3,
) -> TuningResult:
    """Fit every trial and rank by weighted F1 on the validation rows.

    All logistic trials are fitted together, in the same passes (``newton.fit_many``), and scored in one. Rows
    are counted by label and bins once for all forests (``forest.counted_rows``), which are grown from these counts
    in shared passes (``forest.fit_many``).
    """
    logistic = [t for t in trials if t.classifier == LOGISTIC]
    forests = [t for t in trials if t.classifier != LOGISTIC]
    with ThreadPool(parallelism) as pool:
        # Passes of logistic models are short, so that they run beside those of the forests.
        beside = pool.apply_async(_logistic_trials, (train, validation, label, categorical, numeric, logistic))
        found: dict[int, float] = {}
        if forests:
            bins = forest_.Bins.fitted(train, categorical, numeric)
            ready, held_out = pool.map(lambda part: forest_.counted_rows(part, bins, label), (train, validation), chunksize=1)
            models = forest_.fit_many(ready, bins, [_forest_params(t) for t in forests], seed, parallelism)

            def run(model: forest_.Forest) -> float:
                return averaged_metrics(model.counted_predictions(held_out), "y", "prediction").first()["weighted_f1"]

            found |= zip((t.number for t in forests), pool.map(run, models, chunksize=1))
        found |= beside.get()
    values = [found[t.number] for t in trials]
    best = max(zip(values, trials), key=lambda pair: (pair[0], -pair[1].number))[1]
    return TuningResult(best, trial_table(train.sparkSession, trials, values))


def _forest_params(trial: Trial) -> dict[str, int]:
    return {name: int(trial.params[name]) for name in ("trees", "depth", "leaf")}


def _logistic_trials(
    train: DataFrame, validation: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str], trials: Sequence[Trial]
) -> dict[int, float]:
    """Weighted F1 by trial: one fit of all models, one pass over the validation rows."""
    if not trials:
        return {}
    design = newton.Design.fitted(train, categorical, numeric)
    models = newton.fit_many(newton.design_rows(train, design, label), design, [t.params["C"] for t in trials])
    y = F.col(label).cast("int").alias(label)
    predicted = [F.struct(F.lit(t.number).alias("trial"), (m.score() >= 0.5).cast("int").alias("prediction")) for t, m in zip(trials, models)]
    scored = validation.select(y, F.inline(F.array(*predicted)))
    return {r["trial"]: r["weighted_f1"] for r in averaged_metrics(scored, label, "prediction", by=["trial"]).collect()}


def trial_table(spark: SparkSession, trials: Sequence[Trial], values: Sequence[float]) -> DataFrame:
    rows = [
        (t.number, f"trial_{t.number}_{t.classifier}", t.classifier, {k: float(v) for k, v in t.params.items()}, float(v))
        for t, v in zip(trials, values)
    ]
    schema = "trial INT, run_name STRING, classifier STRING, params MAP<STRING, DOUBLE>, weighted_f1 DOUBLE"
    return spark.createDataFrame(rows, schema)


def refit_best(
    best: Trial,
    train: DataFrame,
    test: DataFrame,
    label: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    seed: int = 42,
) -> tuple[newton.Logistic | forest_.Forest, DataFrame]:
    """The best trial fitted on the whole training part, and its metrics on both parts; a forest scores equal rows once."""
    if best.classifier == LOGISTIC:
        model = newton.fit_logistic(train, label, categorical, numeric, best.params["C"])
        scored, y = [model.apply(part) for part in (train, test)], label
    else:
        bins = forest_.Bins.fitted(train, categorical, numeric)
        counted = [forest_.counted_rows(part, bins, label) for part in (train, test)]
        model = forest_.fit_counted(counted[0], bins, **_forest_params(best), seed=seed)
        scored, y = [model.counted_predictions(part) for part in counted], "y"
    on_train, on_test = (evaluate(rows, y, prefix) for rows, prefix in zip(scored, ("training_", "test_")))
    return model, on_train.unionByName(on_test)


def top_importances(model: PipelineModel, sample: DataFrame, k: int = 15, features: str = "features") -> DataFrame:
    """The ``k`` most important model features with their names from the vector's attributes."""
    classifier = model.stages[-1]
    attributes = sample.schema[features].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a.get("name", str(a["idx"])) for group in attributes.values() for a in group}
    rows = [(names.get(i, str(i)), float(v)) for i, v in enumerate(classifier.featureImportances.toArray())]
    table = sample.sparkSession.createDataFrame(rows, "feature STRING, importance DOUBLE")
    return table.orderBy(F.col("importance").desc(), "feature").limit(k)
