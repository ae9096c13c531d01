"""Classification metrics as aggregations.

Rows reduce to a few counts per group in the first (map-side) aggregation; all metrics are then
arithmetic on those counts. Rows without a label or prediction carry no quality information and
are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galewright.functions.numeric import ratio, ratio_or_zero
from galewright.operators.aggregates import to_rows


def labelled(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())


def _of_classes(df: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    """Labelled rows; one of another class fails the job instead of dropping out of the counts."""
    odd = F.concat(F.lit("class outside the list: "), F.col(label).cast("string"), F.lit(", "), F.col(prediction).cast("string"))
    listed = F.col(label).isin(*classes) & F.col(prediction).isin(*classes)
    return labelled(df, label, prediction).filter(F.when(listed, F.lit(True)).otherwise(F.raise_error(odd).cast("boolean")))


def confusion_matrix(
    df: DataFrame, label: str, prediction: str, classes: Sequence = (0, 1), by: Sequence[str] = ()
) -> DataFrame:
    """(label, prediction, row_count) for every pair of classes, zero cells included, in one pass.

    A row of a class that isn't listed fails the job.
    """
    pairs = [(a, b) for a in classes for b in classes]
    counts = [
        F.count_if((F.col(label) == F.lit(a)) & (F.col(prediction) == F.lit(b))).alias(f"_c{i}")
        for i, (a, b) in enumerate(pairs)
    ]
    one_row = _of_classes(df, label, prediction, classes).groupBy(*by).agg(*counts)
    cells = F.array(
        *[
            F.struct(F.lit(a).alias(label), F.lit(b).alias(prediction), F.col(f"_c{i}").alias("row_count"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return one_row.select(*by, F.inline(cells))


def quality_columns(label: str, prediction: str) -> dict[str, Column]:
    """Aggregates for a 0/1 label: accuracy and class-1 precision, recall and F1, 0 where undefined.

    All build on four conditional counts, which Spark computes once each. Usable in any ``agg``.
    """
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    tp, fp = F.count_if((y == 1) & (p == 1)), F.count_if((y == 0) & (p == 1))
    fn, tn = F.count_if((y == 1) & (p == 0)), F.count_if((y == 0) & (p == 0))
    return {
        "accuracy": ratio_or_zero(tp + tn, tp + tn + fp + fn),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    }


def averaged_columns(label: str, prediction: str, classes: Sequence = (0, 1)) -> dict[str, Column]:
    """Support-weighted precision, recall and F1 and the mean F1 of the classes that occur, as aggregates.

    For a list of classes, so that they fit into any ``agg`` beside other metrics; rows without a label
    or prediction are left out. ``averaged_metrics`` needs no list.
    """
    y, p = F.col(label), F.col(prediction)
    known = y.isNotNull() & p.isNotNull()
    weighted = {m: F.lit(0.0) for m in ("precision", "recall", "f1")}
    total, found, f1_sum = F.lit(0), F.lit(0), F.lit(0.0)
    for c in classes:
        support, predicted = F.count_if(known & (y == F.lit(c))), F.count_if(known & (p == F.lit(c)))
        hits = F.count_if((y == F.lit(c)) & (p == F.lit(c)))
        of_class = {
            "precision": ratio_or_zero(hits, predicted),
            "recall": ratio_or_zero(hits, support),
            "f1": ratio_or_zero(2 * hits, predicted + support),
        }
        weighted = {m: w + of_class[m] * support for m, w in weighted.items()}
        total = total + support
        found = found + F.when(support + predicted > 0, 1).otherwise(0)
        f1_sum = f1_sum + of_class["f1"]
    out = {f"weighted_{m}": ratio_or_zero(w, total) for m, w in weighted.items()}
    return out | {"macro_f1": ratio_or_zero(f1_sum, found)}


def binary_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of a 0/1 label; a row of another class fails the job."""
    metrics = [c.alias(n) for n, c in quality_columns(label, prediction).items()]
    return _of_classes(df, label, prediction, (0, 1)).groupBy(*by).agg(*metrics)


def classification_report(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Per class: precision, recall, F1 and support, for any number of classes.

    Every (label, prediction) count is credited to both its classes, so no class list is needed and
    a class that only occurs as a prediction gets support 0.
    """
    return _class_counts(df, label, prediction, by).drop("hits")


def _class_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str]) -> DataFrame:
    cells = labelled(df, label, prediction).groupBy(*by, label, prediction).agg(F.count(F.lit(1)).alias("_n"))
    agree = F.col(label) == F.col(prediction)
    none = F.lit(0).cast("bigint")
    credits = F.array(
        F.struct(
            F.col(label).alias("class"), F.col("_n").alias("support"), none.alias("predicted"),
            F.when(agree, F.col("_n")).otherwise(none).alias("hits"),
        ),
        F.struct(
            F.col(prediction).alias("class"), none.alias("support"), F.col("_n").alias("predicted"), none.alias("hits")
        ),
    )
    per_class = (
        cells.select(*by, F.inline(credits))
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    return per_class.select(
        *by,
        "class",
        ratio_or_zero(F.col("hits"), F.col("predicted")).alias("precision"),
        ratio_or_zero(F.col("hits"), F.col("support")).alias("recall"),
        ratio_or_zero(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
        "hits",
    )


def averaged_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Support-weighted precision, recall and F1, and the plain mean of the class F1 values."""
    return _class_averages(_class_counts(df, label, prediction, by), by)


def all_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = (), positive: object = 1) -> DataFrame:
    """Accuracy, the metrics of the positive class and the averaged metrics, from one pass over the rows."""
    return _class_averages(_class_counts(df, label, prediction, by), by, positive)


def _class_averages(report: DataFrame, by: Sequence[str], positive: object = None) -> DataFrame:
    def weighted(metric: str) -> Column:
        return ratio_or_zero(F.sum(F.col(metric) * F.col("support")), F.sum("support")).alias(f"weighted_{metric}")

    found = [weighted("precision"), weighted("recall"), weighted("f1"), F.avg("f1").alias("macro_f1")]
    if positive is not None:
        found.insert(0, ratio_or_zero(F.sum("hits"), F.sum("support")).alias("accuracy"))
        for metric in ("precision", "recall", "f1"):
            of_class = F.max(F.when(F.col("class") == F.lit(positive), F.col(metric)))
            found.append(F.coalesce(of_class, F.lit(0.0)).alias(metric))
    return report.groupBy(*by).agg(*found)


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = (), runs: int | None = None) -> DataFrame:
    """Exact area under the ROC curve per group; NULL where only one class occurs.

    Rows reduce to counts per distinct score. The scores are cut into consecutive runs at
    approximate quantiles; each run accumulates on its own and then only needs the number of
    negatives in the runs below it. Where the cuts fall changes the balance, never the result. There
    are four runs for each shuffle partition unless ``runs`` says otherwise.
    """
    runs = runs or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    y = F.col(label).cast("int")
    known = labelled(df, label, score)
    per_score = known.groupBy(*by, score).agg(F.count_if(y == 1).alias("_pos"), F.count_if(y == 0).alias("_neg"))
    shares = F.array(*[F.lit(i / runs) for i in range(1, runs)])
    edges = known.agg(F.percentile_approx(score, shares, F.lit(max(10_000, 10 * runs))).alias("e")).scalar()
    cut = per_score.withColumn("_edges", edges).withColumn("_run", F.size(F.filter("_edges", lambda e: e < F.col(score))))

    inside = Window.partitionBy(*by, "_run").orderBy(score).rowsBetween(Window.unboundedPreceding, 0)
    below = F.sum("_neg").over(inside) - F.col("_neg") / 2
    wins = cut.withColumn("_wins", F.col("_pos") * below)
    per_run = wins.groupBy(*by, "_run").agg(
        F.sum("_wins").alias("_wins"), F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg")
    )
    earlier = Window.partitionBy(*by).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    lower = F.coalesce(F.sum("_neg").over(earlier), F.lit(0)).cast("double")
    total = per_run.withColumn("_wins", F.col("_wins") + F.col("_pos") * lower)
    pairs = F.sum("_pos").cast("double") * F.sum("_neg").cast("double")
    return total.groupBy(*by).agg(ratio(F.sum("_wins"), pairs).alias("roc_auc"))


def metric_rows(df: DataFrame, keep: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Wide metrics to (keep…, metric, value) rows."""
    return to_rows(df, keep, {m: F.struct(F.col(m).cast("double").alias("value")) for m in metrics}, "metric")
