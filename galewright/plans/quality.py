"""Classification metrics of the scored log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galewright.functions.numeric import half_up
from galewright.functions.templates import DOUBLE_OUTPUT, CustomMetric, missed_value_metric
from galewright.operators import metrics
from galewright.plans.registration import SCORED, query, with_sql
from galewright.sources.fixtures import scored_events, table

LABEL, PREDICTION, MODEL, TIME = "y_flag", "prediction", "model_version", "inference_timestamp"


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: half_up(c) for c in columns})


def counts_sql(source: str, by: str) -> str:
    """tp, fp, fn, tn per group as a named query ``c``."""
    group = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return f"""c AS (SELECT {group}count(*) AS n,
      CAST(count(*) FILTER (y_flag = 1 AND prediction = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (y_flag = 0 AND prediction = 1) AS DOUBLE) AS fp,
      CAST(count(*) FILTER (y_flag = 1 AND prediction = 0) AS DOUBLE) AS fn, CAST(count(*) FILTER (y_flag = 0 AND prediction = 0) AS DOUBLE) AS tn
      FROM {source}{tail})"""


ACCURACY = "COALESCE((tp + tn) / NULLIF(tp + tn + fp + fn, 0), 0)"
PRECISION = "COALESCE(tp / NULLIF(tp + fp, 0), 0)"
RECALL = "COALESCE(tp / NULLIF(tp + fn, 0), 0)"
F1 = "COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0)"
F1_ZERO = "COALESCE(2 * tn / NULLIF(2 * tn + fp + fn, 0), 0)"
PRECISION_ZERO = "COALESCE(tn / NULLIF(tn + fn, 0), 0)"
RECALL_ZERO = "COALESCE(tn / NULLIF(tn + fp, 0), 0)"
WEIGHTED_F1 = f"(({F1}) * (tp + fn) + ({F1_ZERO}) * (tn + fp)) / (tp + tn + fp + fn)"


@query(
    "confusion_matrix",
    with_sql(
        SCORED,
        "cells AS (SELECT m.model_version, a.v AS y_flag, b.v AS prediction FROM (SELECT DISTINCT model_version FROM scored) m, (VALUES (0), (1)) a(v), (VALUES (0), (1)) b(v))",
    )
    + """SELECT model_version, y_flag, prediction, count(scored.event_id) AS row_count
      FROM cells LEFT JOIN scored USING (model_version, y_flag, prediction) GROUP BY ALL""",
)
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_matrix(scored_events(spark, sf), LABEL, PREDICTION, by=[MODEL])


@query(
    "binary_metrics",
    with_sql(SCORED, counts_sql("scored", "model_version"))
    + f"""SELECT model_version, ROUND({ACCURACY}, 6) AS accuracy, ROUND({PRECISION}, 6) AS "precision", ROUND({RECALL}, 6) AS recall,
      ROUND({F1}, 6) AS f1 FROM c""",
)
def binary_metrics(spark: SparkSession, sf: str) -> DataFrame:
    wide = metrics.binary_metrics(scored_events(spark, sf), LABEL, PREDICTION, [MODEL])
    return rounded(wide, "accuracy", "precision", "recall", "f1")


@query(
    "weighted_macro_metrics",
    with_sql(SCORED, counts_sql("scored", "model_version"))
    + f"""SELECT model_version,
      ROUND((({PRECISION}) * (tp + fn) + ({PRECISION_ZERO}) * (tn + fp)) / (tp + tn + fp + fn), 6) AS weighted_precision,
      ROUND((({RECALL}) * (tp + fn) + ({RECALL_ZERO}) * (tn + fp)) / (tp + tn + fp + fn), 6) AS weighted_recall,
      ROUND({WEIGHTED_F1}, 6) AS weighted_f1, ROUND((({F1}) + ({F1_ZERO})) / 2, 6) AS macro_f1 FROM c""",
)
def weighted_macro_metrics(spark: SparkSession, sf: str) -> DataFrame:
    wide = metrics.averaged_metrics(scored_events(spark, sf), LABEL, PREDICTION, [MODEL])
    return rounded(wide, "weighted_precision", "weighted_recall", "weighted_f1", "macro_f1")


# A label with five classes and a prediction that has a class of its own, from the orders table.
_PRIORITY = """p AS (SELECT o_orderpriority AS label, CASE WHEN o_totalprice < 50000 THEN '5-LOW' WHEN o_totalprice < 100000 THEN '3-MEDIUM'
      WHEN o_totalprice < 200000 THEN '1-URGENT' ELSE '0-UNSEEN' END AS guess FROM orders)"""


@query(
    "classification_report",
    with_sql(
        _PRIORITY,
        "k AS (SELECT label AS class FROM p UNION SELECT guess FROM p)",
        """s AS (SELECT class, (SELECT count(*) FROM p WHERE label = class) AS support,
      (SELECT count(*) FROM p WHERE guess = class) AS predicted, (SELECT count(*) FROM p WHERE label = class AND guess = class) AS hits FROM k)""",
    )
    + """SELECT class, ROUND(COALESCE(hits / CAST(NULLIF(predicted, 0) AS DOUBLE), 0), 6) AS "precision",
      ROUND(COALESCE(hits / CAST(NULLIF(support, 0) AS DOUBLE), 0), 6) AS recall,
      ROUND(COALESCE(2 * hits / CAST(NULLIF(predicted + support, 0) AS DOUBLE), 0), 6) AS f1, support FROM s""",
)
def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("o_totalprice")
    guess = (
        F.when(price < 50000, F.lit("5-LOW")).when(price < 100000, F.lit("3-MEDIUM")).when(price < 200000, F.lit("1-URGENT")).otherwise(F.lit("0-UNSEEN"))
    )
    guessed = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("label"), guess.alias("guess"))
    return rounded(metrics.classification_report(guessed, "label", "guess"), "precision", "recall", "f1")


@query(
    "roc_auc",
    with_sql(
        SCORED,
        "g AS (SELECT model_version, balance, count(*) FILTER (y_flag = 1) AS pos, count(*) FILTER (y_flag = 0) AS neg FROM scored GROUP BY ALL)",
        "r AS (SELECT *, sum(neg) OVER (PARTITION BY model_version ORDER BY balance ROWS UNBOUNDED PRECEDING) - neg AS below FROM g)",
    )
    + """SELECT model_version, ROUND(CAST(sum(pos * (below + CAST(neg AS DOUBLE) / 2)) AS DOUBLE) / CAST(sum(pos) AS DOUBLE) / CAST(sum(neg) AS DOUBLE), 6) AS roc_auc
      FROM r GROUP BY model_version""",
)
def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.roc_auc(scored_events(spark, sf), LABEL, "balance", [MODEL]), "roc_auc")


@query(
    "missed_value_metric",
    with_sql(SCORED)
    + """SELECT model_version, ROUND(avg(CASE WHEN y_flag = 1 AND prediction <> y_flag THEN -greatest(balance, CAST(0 AS DOUBLE))
      ELSE CAST(0 AS DOUBLE) END), 6) AS missed_value FROM scored GROUP BY model_version""",
)
def missed_value(spark: SparkSession, sf: str) -> DataFrame:
    metric = missed_value_metric("balance").column(PREDICTION, LABEL)
    return rounded(scored_events(spark, sf).groupBy(MODEL).agg(metric), "missed_value")


@query(
    "custom_metric",
    with_sql(SCORED)
    + """SELECT job, ROUND(sum(CASE WHEN prediction = 1 AND y_flag = 0 THEN balance ELSE 0 END) / CAST(count(*) AS DOUBLE), 6) AS wasted_value,
      CAST(max(abs(prediction - y_flag)) AS DOUBLE) AS worst_error FROM scored GROUP BY job""",
)
def custom_metric(spark: SparkSession, sf: str) -> DataFrame:
    wasted = CustomMetric(
        "wasted_value", "sum(if({{prediction_col}} = 1 AND {{label_col}} = 0, balance, 0D)) / count(*)", DOUBLE_OUTPUT
    )
    worst = CustomMetric("worst_error", "max(abs({{prediction_col}} - {{ label_col }}))", DOUBLE_OUTPUT)
    built = [m.column(PREDICTION, LABEL) for m in (wasted, worst)]
    return rounded(scored_events(spark, sf).groupBy("job").agg(*built), "wasted_value")
