"""A pipeline stage for what ``pyspark.ml.feature.Imputer`` leaves out: categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewright.operators.prepare import most_frequent


class ModeImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the most frequent value of each text column, the smallest value among ties, in one job."""

    def __init__(self, inputCols: Sequence[str] | None = None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=list(inputCols))

    def _fit(self, df: DataFrame) -> ModeImputerModel:
        names = self.getInputCols()
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in names])
        values = df.select(F.inline(cells)).where(F.col("value").isNotNull())
        counts = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
        modes = dict(counts.groupBy("column").agg(most_frequent("value")).collect())
        # A column without any value has nothing to fill with and stays NULL.
        known = [c for c in names if c in modes]
        return ModeImputerModel(names, known, [modes[c] for c in known])


class ModeImputerModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Replaces NULL by the fitted value, in place."""

    filled = Param(Params._dummy(), "filled", "columns with a fitted value", TypeConverters.toListString)
    fills = Param(Params._dummy(), "fills", "fitted value per filled column", TypeConverters.toListString)

    def __init__(self, inputCols: Sequence[str] | None = None, filled: Sequence[str] = (), fills: Sequence[str] = ()):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=list(inputCols), filled=list(filled), fills=list(fills))

    def _transform(self, df: DataFrame) -> DataFrame:
        values = dict(zip(self.getOrDefault(self.filled), self.getOrDefault(self.fills)))
        return df.fillna(values) if values else df
