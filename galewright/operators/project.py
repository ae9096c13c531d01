"""Projections, filters, slices and metadata columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galewright.functions.rules import Preset


def reorder_metadata_last(df: DataFrame, metadata: Sequence[str]) -> DataFrame:
    """All other columns in their order, then the metadata columns."""
    return df.select(*[c for c in df.columns if c not in metadata], *metadata)


def stamp_metadata(
    df: DataFrame, model_name: str, model_alias: str, model_version: str, scored_at: Column | None = None
) -> DataFrame:
    """Add model name, alias, version and the scoring time."""
    return df.withColumns(
        {
            "model_name": F.lit(model_name),
            "model_alias": F.lit(model_alias),
            "model_version": F.lit(str(model_version)),
            "scored_at": F.current_timestamp() if scored_at is None else scored_at,
        }
    )


def split_by_dtype(df: DataFrame) -> tuple[list[str], list[str]]:
    """(categorical, numeric) column names by stored type."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    categorical = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]
    return categorical, numeric


def features_without_label(df: DataFrame, key: str, features: Sequence[str], label: str) -> tuple[DataFrame, DataFrame]:
    """The feature frame (key and features) and the label frame (key and label) of one keyed frame."""
    if label in features:
        raise ValueError(f"label {label} is listed as a feature")
    return df.select(key, *features), df.select(key, label)


class MissingInput(ValueError):
    """The source lacks an input column of the model, or stores it with another type."""


def model_inputs(model: PipelineModel) -> list[str]:
    """Source columns a fitted pipeline needs: inputs of its stages that no earlier stage produces."""
    produced: set[str] = set()
    needed: list[str] = []
    for stage in model.stages:
        inputs = _param_columns(stage, ("inputCol", "inputCols", "featuresCol"))
        needed += [c for c in inputs if c not in produced and c not in needed]
        produced.update(_param_columns(stage, ("outputCol", "outputCols", "predictionCol", "probabilityCol")))
    return needed


def required_inputs(model: PipelineModel | None, preset: Preset) -> dict[str, str | None]:
    """Input columns of the fitted pipeline, else those of the preset; features carry the preset's types."""
    if model is None:
        return dict(preset.inputs)
    return {c: preset.feature_types.get(c, preset.inputs.get(c)) for c in model_inputs(model)}


def _param_columns(stage, names: Sequence[str]) -> list[str]:
    found: list[str] = []
    for name in names:
        if stage.hasParam(name) and stage.isDefined(name):
            value = stage.getOrDefault(name)
            found += [value] if isinstance(value, str) else list(value)
    return found


def require_columns(df: DataFrame, inputs: Mapping[str, str | None]) -> DataFrame:
    """Project to the model inputs; raise when one is missing or has another type (None: any type)."""
    stored = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    missing = [c for c in inputs if c not in stored]
    wrong = [f"{c}: {stored[c]}, not {t}" for c, t in inputs.items() if c in stored and t and stored[c] != t]
    if missing or wrong:
        raise MissingInput(f"missing {missing}, wrong type {wrong}")
    return df.select(*inputs)


@dataclass(frozen=True)
class Slice:
    """A slice of the log: a bare column (one slice per value) or a boolean expression (true/false)."""

    key: str

    def value(self) -> Column:
        return null_as_text(F.expr(self.key))


def null_as_text(value: Column) -> Column:
    """The value as text, ``null`` for NULL. A text ``null`` becomes ``\\null``, and one that already has
    backslashes before it gets one more, so that no two values share a text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("null")).when(text.rlike(r"^\\*null$"), F.concat(F.lit("\\"), text)).otherwise(text)


def slice_rows(df: DataFrame, slices: Sequence[str], overall: str = ":all") -> DataFrame:
    """Repeat every row once per slice and once overall, with ``slice_key`` and ``slice_value``.

    The rows meet a partial aggregation before any shuffle, so the repetition costs CPU only.
    """
    cells = [F.struct(F.lit(overall).alias("slice_key"), F.lit(overall).alias("slice_value"))]
    cells += [F.struct(F.lit(s).alias("slice_key"), Slice(s).value().alias("slice_value")) for s in slices]
    exploded = df.withColumn("_slice", F.explode(F.array(*cells)))
    return exploded.select(*df.columns, "_slice.slice_key", "_slice.slice_value")
