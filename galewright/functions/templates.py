"""User-defined aggregates written as SQL text with placeholders."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_PLACEHOLDER = re.compile(r"\{\{\s*(\w+)\s*\}\}")


@dataclass(frozen=True)
class CustomMetric:
    """A metric name, its SQL text and the declared result type (JSON of a ``StructField``)."""

    name: str
    definition: str
    output: str
    input_columns: tuple[str, ...] = (":table",)

    def column(self, prediction_col: str, label_col: str) -> Column:
        """Fill the placeholders with checked identifiers and cast to the declared type.

        A metric over listed input columns is evaluated once per column in the caller, which passes
        it as ``{{input_column}}`` through :meth:`columns`; ``:table`` stands for the whole row.
        """
        return self._build({"prediction_col": prediction_col, "label_col": label_col}).alias(self.name)

    def columns(self, prediction_col: str, label_col: str) -> list[tuple[str, Column]]:
        """(input column, aggregate) pairs; ``:table`` for a whole-row metric."""
        names = {"prediction_col": prediction_col, "label_col": label_col}
        built = []
        for source in self.input_columns:
            filled = names if source == ":table" else names | {"input_column": source}
            built.append((source, self._build(filled)))
        return built

    def _build(self, names: dict[str, str]) -> Column:
        for value in names.values():
            if not _IDENTIFIER.fullmatch(value):
                raise ValueError(f"not a plain column name: {value!r}")

        def fill(match: re.Match) -> str:
            if match.group(1) not in names:
                raise ValueError(f"unknown placeholder {match.group(0)} in metric {self.name}")
            return f"`{names[match.group(1)]}`"

        text = _PLACEHOLDER.sub(fill, self.definition)
        return F.expr(text).cast(declared_type(self.output))


def declared_type(field_json: str) -> T.DataType:
    import json

    return T.StructField.fromJson(json.loads(field_json)).dataType


DOUBLE_OUTPUT = '{"metadata":{},"name":"output","nullable":true,"type":"double"}'

def missed_value_metric(amount: str = "balance", name: str = "missed_value") -> CustomMetric:
    """Mean of the negated positive amount over rows whose positive label was missed, 0 elsewhere."""
    if not _IDENTIFIER.fullmatch(amount):
        raise ValueError(f"not a plain column name: {amount!r}")
    text = (
        "avg(if(int({{label_col}}) = 1 and int({{prediction_col}}) <> 1, "
        f"- greatest(double(`{amount}`), 0D), 0D))"
    )
    return CustomMetric(name, text, DOUBLE_OUTPUT)
