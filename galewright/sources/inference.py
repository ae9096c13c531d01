"""Types of delimited text, found by one aggregation over the values.

Every value has a narrowest type; a column's type is the least one that holds all of them. The report
says of each type how many rows needed it and which came first, so a column that one odd row widened
to text shows that row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Type names in order, and the pattern of each type's values.
TYPES = ("int", "bigint", "double", "date", "timestamp_ntz", "boolean", "string")
_INTEGER = r"^[+-]?[0-9]{1,18}$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"
_BOOLEAN = r"^(?i:true|false)$"


def narrowest(value: Column) -> Column:
    """The narrowest type of a text; NULL for NULL and for blank text, which fit every type."""
    text = F.trim(value)
    whole = F.when(text.rlike(_INTEGER), text.try_cast("bigint"))
    return (
        F.when(text == "", F.lit(None))
        .when(whole.between(-(2**31), 2**31 - 1), F.lit("int"))
        .when(whole.isNotNull(), F.lit("bigint"))
        .when(text.rlike(_NUMBER), F.lit("double"))
        .when(text.rlike(_DATE) & text.try_cast("date").isNotNull(), F.lit("date"))
        .when(text.rlike(_TIMESTAMP) & text.try_cast("timestamp_ntz").isNotNull(), F.lit("timestamp_ntz"))
        .when(text.rlike(_BOOLEAN), F.lit("boolean"))
        .when(text.isNotNull(), F.lit("string"))
    )


def least_common(found: Column) -> Column:
    """The type that holds all types of an array: the widest within numbers or within dates, else text."""

    def only(*types: str) -> Column:
        return (F.size(found) > 0) & (F.size(F.array_except(found, F.array(*[F.lit(t) for t in types]))) == 0)

    case = F.when(only("int"), "int").when(only("int", "bigint"), "bigint").when(only("int", "bigint", "double"), "double")
    case = case.when(only("date"), "date").when(only("date", "timestamp_ntz"), "timestamp_ntz").when(only("boolean"), "boolean")
    return case.otherwise("string")


def type_report(texts: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, narrowest, row_count, first_key, inferred)``: the types met in each text column.

    One pass: rows reduce to a count and the smallest key per column and type before the shuffle. A column
    without values has no row here and stays text.
    """
    names = list(columns or [c for c in texts.columns if c != key])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), narrowest(F.col(f"`{c}`")).alias("narrowest")) for c in names])
    met = texts.select(F.col(f"`{key}`").alias("_key"), F.inline(cells)).where("narrowest IS NOT NULL")
    counts = met.groupBy("column_name", "narrowest").agg(F.count(F.lit(1)).alias("row_count"), F.min("_key").alias("first_key"))
    # At most one row per column and type from here on.
    seen = counts.groupBy("column_name").agg(F.collect_list(F.struct("narrowest", "row_count", "first_key")).alias("met"))
    return seen.select("column_name", F.inline("met"), least_common(F.col("met.narrowest")).alias("inferred"))


def typed(texts: DataFrame, report: DataFrame) -> DataFrame:
    """The text columns cast to their inferred types; blank text becomes NULL outside text columns."""
    types = {r["column_name"]: r["inferred"] for r in report.select("column_name", "inferred").distinct().collect()}  # a row a column
    casts = {c: F.trim(F.col(f"`{c}`")).try_cast(t) for c, t in types.items() if t != "string"}
    return texts.withColumns(casts)


def read_texts(spark: SparkSession, path: str, separator: str = ";") -> DataFrame:
    """Delimited files with a header, every column as text."""
    return spark.read.option("sep", separator).option("header", True).option("mode", "FAILFAST").csv(path)
