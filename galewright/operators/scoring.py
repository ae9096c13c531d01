"""Batch scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewright.operators.joins import feature_lookup
from galewright.operators.project import reorder_metadata_last, require_columns, stamp_metadata
from galewright.session import ship_package
from galewright.sources.snapshots import SnapshotTable

# The columns that scoring stamps on its rows.
STAMPS = ("model_name", "model_alias", "model_version", "scored_at")


@dataclass(frozen=True)
class LinearModel:
    """A logistic model with explicit coefficients, for numbers and for category values."""

    intercept: float
    numeric: Mapping[str, float] = field(default_factory=dict)
    categorical: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    cutoff: float = 0.5

    @property
    def inputs(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    def score(self) -> Column:
        """Class-1 probability as one expression. A NULL number gives NULL; an unknown category adds 0."""
        z = F.lit(float(self.intercept))
        for c, weight in self.numeric.items():
            z = z + F.col(c).cast("double") * F.lit(float(weight))
        for c, weights in self.categorical.items():
            term = F.lit(0.0)
            for value, weight in weights.items():
                term = F.when(F.col(c) == F.lit(value), F.lit(float(weight))).otherwise(term)
            z = z + term
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def prediction(self) -> Column:
        score = self.score()
        return F.when(score >= self.cutoff, F.lit(1.0)).when(score < self.cutoff, F.lit(0.0))

    def predict(self, rows: pd.DataFrame) -> pd.Series:
        """The same model on a pandas batch, as a model from another library would offer it."""
        import numpy as np

        z = pd.Series(float(self.intercept), index=rows.index)
        for c, weight in self.numeric.items():
            z = z + rows[c].astype("float64") * weight
        for c, weights in self.categorical.items():
            z = z + rows[c].map(weights).fillna(0.0).astype("float64")
        score = 1.0 / (1.0 + np.exp(-z))
        return (score >= self.cutoff).astype("float64").where(score.notna())


def score_linear(df: DataFrame, model: LinearModel) -> DataFrame:
    """Add ``score`` and ``prediction`` with built-in expressions only."""
    return df.withColumns({"score": model.score(), "prediction": model.prediction()})


def batch_score(df: DataFrame, load: Callable[[], object], inputs: Sequence[str], name: str = "prediction") -> DataFrame:
    """Apply a foreign model (anything with ``predict(pandas frame)``) to Arrow batches.

    ``load`` runs once per task, not once per batch; give it a path to load from, rather than a
    large model captured in the closure. Spark models need no UDF: use ``transform``.
    """

    @F.pandas_udf("double")
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            yield pd.Series(model.predict(batch), dtype="float64")

    ship_package(df.sparkSession)
    return df.withColumn(name, predict(F.struct(*[F.col(c) for c in inputs])))


def model_path(root: str, name: str, version: str | int) -> str:
    return f"{root}/{name}/version={version}"


def save_model(model: PipelineModel, root: str, name: str, version: str | int) -> None:
    """Store a fitted pipeline below ``root`` by name and version; an existing version is never replaced."""
    model.save(model_path(root, name, version))


def load_model(root: str, name: str, version: str | int) -> PipelineModel:
    return PipelineModel.load(model_path(root, name, version))


def score_with_alias(
    df: DataFrame,
    root: str,
    aliases: DataFrame,
    name: str,
    alias: str,
    inputs: Mapping[str, str | None],
    keep: Sequence[str],
    output: SnapshotTable,
    scored_at: Column | None = None,
) -> DataFrame:
    """Score a table with the stored model that an alias names, and count the stored rows by prediction.

    Alias to version, load that version, check its inputs (name and type) in the source, score, stamp the
    model and the time, put these columns last, commit to ``output`` with an unchanged schema, and count
    ``(prediction, row_count)`` from what was written. An unknown alias raises.
    """
    version = aliases.where((F.col("model_name") == name) & (F.col("alias") == alias)).agg(F.max("version")).first()[0]
    if version is None:
        raise ValueError(f"model {name} has no alias {alias}")
    require_columns(df, inputs)
    scored = load_model(root, name, version).transform(df).select(*keep, F.col("prediction").cast("double").alias("prediction"))
    stamped = stamp_metadata(scored, name, alias, version, scored_at)
    output.overwrite(reorder_metadata_last(stamped, STAMPS), "score", keep_schema=True)
    return output.as_of().groupBy("prediction").agg(F.count(F.lit(1)).alias("row_count"))


def score_by_key(
    keys: DataFrame, features: DataFrame, key: str, model: LinearModel, hot_share: float | None = None
) -> DataFrame:
    """Score a frame that only holds keys: look the features up, then apply the model."""
    found = feature_lookup(keys, features, key, model.inputs, hot_share=hot_share)
    return score_linear(found, model)
