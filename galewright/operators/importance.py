"""Permutation importance: what a column's values are worth to a model on held-out rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewright.functions.hashing import digest
from galewright.operators.keys import global_row_number
from galewright.operators.metrics import averaged_metrics
from galewright.session import materialize

WHOLE = ":none"


def permutation_importance(
    rows: DataFrame, key: str, label: str, columns: Sequence[str], predict: Callable[[DataFrame], DataFrame], salt: str | int = 42
) -> DataFrame:
    """``(column_name, weighted_f1, importance)``: weighted F1 with the column's values exchanged, and the drop.

    In the order of the key's digests, each row takes the values of the next one and the last row those of
    the first, which is a permutation that other engines can repeat. The order comes from range partitions,
    so no task sorts all rows. ``predict`` adds ``prediction`` and sees every row once per column and once
    unchanged, in a single pass. NULLs are exchanged like other values; no rows give no result.
    """
    columns = list(columns)
    marked = rows.select(key, label, *columns).withColumn("_digest", digest(key, salt=salt))
    numbered = materialize(global_row_number(marked, ["_digest", key], "_row").drop("_digest"), "permuted")
    total = numbered.count()
    before = (F.col("_row") + (total - 2)) % F.lit(max(total, 1)) + 1  # row 1 gives its values to the last row
    given = numbered.select(before.alias("_row"), F.struct(*columns).alias("_next"))
    both = numbered.join(given, "_row")
    versions = F.array(F.lit(WHOLE), *[F.lit(c) for c in columns])
    each = both.withColumn("column_name", F.explode(versions))
    changed = {c: F.when(F.col("column_name") == c, F.col("_next").getField(c)).otherwise(F.col(c)) for c in columns}
    scored = predict(each.withColumns(changed).drop("_next", "_row"))
    flat = scored.select("column_name", F.col(label).cast("int").alias(label), F.col("prediction").cast("int").alias("prediction"))
    quality = materialize(averaged_metrics(flat, label, "prediction", by=["column_name"]).select("column_name", "weighted_f1"), "importance")
    whole = quality.filter(F.col("column_name") == WHOLE).agg(F.max("weighted_f1")).scalar()
    return quality.filter(F.col("column_name") != WHOLE).withColumn("importance", whole - F.col("weighted_f1"))
