"""Metrics against Spark's evaluators, and their edges."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from galewright.functions.templates import DOUBLE_OUTPUT, CustomMetric, missed_value_metric
from galewright.operators import drift, metrics, profile, registry
from galewright.sources.fixtures import scored_events


@pytest.fixture(scope="module")
def scored(spark, tiny):
    return scored_events(spark, tiny).withColumns(
        {"y": F.col("y_flag").cast("double"), "p": F.col("prediction").cast("double")}
    ).cache()


@pytest.mark.parametrize(
    "ours, theirs",
    [("weighted_f1", "f1"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall"), ("accuracy", "accuracy")],
)
def test_averages_equal_the_evaluator(scored, ours, theirs):
    evaluator = MulticlassClassificationEvaluator(labelCol="y", predictionCol="p", metricName=theirs)
    assert metrics.all_metrics(scored, "y_flag", "prediction").first()[ours] == pytest.approx(evaluator.evaluate(scored))


@pytest.mark.parametrize("runs", [2, 7, 256])
def test_auc_equals_the_evaluator(scored, runs):
    coarse = scored.withColumn("s", F.round("balance", 0))
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0)
    assert metrics.roc_auc(coarse, "y_flag", "s", runs=runs).first()[0] == pytest.approx(evaluator.evaluate(coarse))


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "y INT, p INT")


def test_no_predicted_positive_gives_zero(spark):
    row = metrics.binary_metrics(frame(spark, [(1, 0), (0, 0)]), "y", "p").first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_rows_without_label_are_left_out(spark):
    df = frame(spark, [(1, 1), (None, 1), (0, None)])
    assert metrics.binary_metrics(df, "y", "p").first()["accuracy"] == 1.0
    assert metrics.all_metrics(df, "y", "p").first()["accuracy"] == 1.0


def test_binary_and_one_pass_metrics_agree(scored):
    one = metrics.binary_metrics(scored, "y_flag", "prediction", ["job"]).orderBy("job").collect()
    two = metrics.all_metrics(scored, "y_flag", "prediction", ["job"]).orderBy("job").collect()
    for a, b in zip(one, two):
        assert [a[m] for m in ("accuracy", "precision", "recall", "f1")] == pytest.approx([b[m] for m in ("accuracy", "precision", "recall", "f1")])


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.4)], "y INT, s DOUBLE")
    assert metrics.roc_auc(df, "y", "s").first()[0] is None


def test_auc_of_ties_and_order(spark):
    df = spark.createDataFrame([("up", 0, 1.0), ("up", 1, 2.0), ("down", 1, 1.0), ("down", 0, 2.0), ("tie", 1, 1.0), ("tie", 0, 1.0)], "g STRING, y INT, s DOUBLE")
    assert {r["g"]: r["roc_auc"] for r in metrics.roc_auc(df, "y", "s", ["g"]).collect()} == {"up": 1.0, "down": 0.0, "tie": 0.5}


def test_confusion_matrix_fills_empty_cells(spark):
    found = metrics.confusion_matrix(frame(spark, [(1, 1)] * 3), "y", "p")
    assert sorted(tuple(r) for r in found.collect()) == [(0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 1, 3)]


def test_unlisted_class_fails_instead_of_dropping_out(spark):
    from pyspark.errors import PySparkException

    three = frame(spark, [(1, 1), (0, 0), (2, 2), (2, 0)])
    for found in (metrics.confusion_matrix(three, "y", "p"), metrics.binary_metrics(three, "y", "p")):
        with pytest.raises(PySparkException, match="class outside the list"):
            found.collect()
    assert metrics.confusion_matrix(three, "y", "p", (0, 1, 2)).agg(F.sum("row_count")).first()[0] == 4


def test_null_is_not_the_text_null(spark):
    from galewright.operators import drift as drift_
    from galewright.operators.project import null_as_text, slice_rows

    odd = spark.createDataFrame([(None,), ("null",), ("\\null",), ("x",)], "c STRING")
    assert {r[0] for r in odd.select(null_as_text(F.col("c"))).collect()} == {"null", "\\null", "\\\\null", "x"}
    assert slice_rows(odd, ["c"]).filter("slice_key = 'c'").select("slice_value").distinct().count() == 4
    assert drift_.merge_on_category(odd, odd, ["c"]).count() == 4


def test_slices_agree_with_grouping_sets(scored):
    aggregates = [F.count("*").alias("n"), F.round(F.avg("balance"), 6).alias("v")]
    slices = ["job", "balance >= 100", "prediction"]
    named = scored.withColumn("big", F.expr("CAST(balance >= 100 AS STRING)")).withColumn("said", F.col("prediction").cast("string"))
    of = {"job": "job", "balance >= 100": "big", "prediction": "said"}
    key = F.lit(":all")
    value = F.lit(":all")
    for s, c in of.items():
        key = F.when(F.grouping(c) == 0, F.lit(s)).otherwise(key)
        value = F.when(F.grouping(c) == 0, F.col(c)).otherwise(value)
    keys = ["model_version"]
    sets = named.groupingSets([keys, *([*keys, c] for c in of.values())], *keys, *of.values())
    sets = sets.agg(key.alias("slice_key"), value.alias("slice_value"), *aggregates)
    exploded = profile.sliced_agg(scored, keys, slices, aggregates)
    pick = ["model_version", "slice_key", "slice_value", "n", "v"]
    assert sorted(map(tuple, sets.select(pick).collect())) == sorted(map(tuple, exploded.select(pick).collect()))
    assert profile.sliced_agg(scored, ["model_version"], [], aggregates).count() == 2


def test_profile_reads_the_log_once(scored, spark, tiny, plan_of):
    rows = profile.profile_metrics(
        scored_events(spark, tiny), "inference_timestamp", "model_version", "y_flag", "prediction", ["job"], ["balance"], [missed_value_metric()]
    )
    plan = plan_of(rows)
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_averages_in_one_aggregation_equal_the_grouped_ones(spark):
    three = frame(spark, [(1, 1), (0, 0), (2, 2), (2, 0), (1, 0), (0, 2), (1, None), (None, 1)])
    cells = {n: c.alias(n) for n, c in metrics.averaged_columns("y", "p", (0, 1, 2, 3)).items()}
    wanted = metrics.averaged_metrics(three, "y", "p").first().asDict()
    assert three.agg(*cells.values()).first().asDict() == pytest.approx(wanted)
    assert three.limit(0).agg(*cells.values()).first()["macro_f1"] == 0


def test_sketched_distinct_counts_are_close(spark):
    df = spark.range(5000).select((F.col("id") % 700).alias("a"), F.lit(None).cast("string").alias("b"))
    for exact in (True, False):
        found = {r["column_name"]: r["distinct_count"] for r in profile.column_profile(df, exact_distinct=exact).collect()}
        assert found["b"] == 0 and found["a"] == pytest.approx(700, rel=0 if exact else 0.1)


def test_template_rejects_anything_but_names(spark):
    metric = CustomMetric("m", "avg({{prediction_col}})", DOUBLE_OUTPUT)
    with pytest.raises(ValueError, match="plain column name"):
        metric.column("p) + (1", "y")
    with pytest.raises(ValueError, match="placeholder"):
        CustomMetric("m", "avg({{other}})", DOUBLE_OUTPUT).column("p", "y")


def test_template_over_input_columns(spark, scored):
    metric = CustomMetric("spread", "max({{input_column}}) - min({{input_column}})", DOUBLE_OUTPUT, ("balance", "prediction"))
    built = dict(metric.columns("prediction", "y_flag"))
    row = scored.agg(built["balance"].alias("b"), built["prediction"].alias("p")).first()
    assert row["p"] == 1.0 and row["b"] > 0


def test_declared_type_is_applied(spark, scored):
    metric = CustomMetric("n", "count(*)", '{"metadata":{},"name":"output","nullable":true,"type":"long"}')
    assert scored.agg(metric.column("prediction", "y_flag")).schema["n"].dataType.simpleString() == "bigint"


def counts(spark, rows):
    return spark.createDataFrame(rows, "c STRING")


def test_equal_sides_have_no_drift(spark):
    df = counts(spark, [("a",), ("a",), ("b",), (None,)])
    row = drift.drift(df, df, ["c"]).first()
    assert [row[m] for m in drift.DRIFT_METRICS] == pytest.approx([0, 0, 0, 0, 1])
    assert row["degrees_of_freedom"] == 2


def test_disjoint_sides_drift_most(spark):
    row = drift.drift(counts(spark, [("a",)] * 4), counts(spark, [("b",)] * 2), ["c"]).first()
    assert row["js_distance"] == pytest.approx(1) and row["tv_distance"] == 1 and row["l_infinity"] == 1
    assert row["chi_squared"] == pytest.approx(6)


def test_distances_keep_their_bounds(spark, scored):
    first, second = scored.filter("event_id % 3 = 0"), scored.filter("event_id % 3 <> 0")
    for row in drift.drift(first, second, ["job", "y_flag", "prediction"]).collect():
        assert 0 <= row["l_infinity"] <= row["tv_distance"] + 1e-12 <= 1 and 0 <= row["js_distance"] <= 1
        assert 0 <= row["chi_squared_pvalue"] <= 1


def test_empty_side_gives_null(spark):
    row = drift.drift(counts(spark, [("a",)]), counts(spark, []), ["c"]).first()
    assert row["js_distance"] is None and row["tv_distance"] is None and row["chi_squared"] is None


def test_windowed_drift_counts_what_a_side_lacks(spark):
    """A slice unknown to the baseline has no distance; a category missing in a window still counts."""
    def log(rows):
        schema = "t TIMESTAMP_NTZ, m INT, s STRING, c STRING"
        return spark.createDataFrame([(f"2024-01-0{d} 05:00:00", 1, s, c) for d, s, c in rows], "t STRING, m INT, s STRING, c STRING").select(
            *[F.col(n.split()[0]).cast(n.split()[1].lower()) for n in schema.split(", ")]
        )

    base = log([(1, "old", "a"), (1, "old", "b")])
    now = log([(2, "old", "a"), (3, "new", "a"), (3, "old", "a"), (3, "old", "b")])
    rows = drift.drift_metrics(base, now, ["c"], "t", "m", ["s"]).filter("metric = 'tv_distance'").collect()
    found = {(r["window_start"].day, r["slice_value"]): (r["value"], r["baseline_rows"], r["current_rows"]) for r in rows}
    assert found == {
        (2, ":all"): (0.5, 2, 1), (2, "old"): (0.5, 2, 1), (3, "old"): (0.0, 2, 2), (3, "new"): (None, 0, 1),
        (3, ":all"): (pytest.approx(1 / 6), 2, 3),
    }


@pytest.mark.parametrize(
    "x, df, p", [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (18.307038, 10, 0.05), (0.0, 3, 1.0), (24.724970, 11, 0.01), (2000.0, 4, 0.0)]
)
def test_chi_squared_tail(x, df, p):
    assert float(drift.chi_squared_tail(x, df)) == pytest.approx(p, abs=1e-6)


def test_chi_squared_tail_of_an_array():
    x, df = np.array([0.0, 5.0, 5.0, 1e6, 3e5]), np.array([2, 0, 4, 1_000_000, 4])
    found = drift.chi_squared_tail(x, df)
    assert found[:2].tolist() == [1.0, 1.0] and found[4] == 0.0
    assert found[2] == pytest.approx(3.5 * np.exp(-2.5)) and found[3] == pytest.approx(0.49981193, abs=1e-7)


def test_chi_squared_equals_spark_ml(spark, scored):
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    sides = scored.withColumn("side", (F.col("event_id") % 2).cast("double"))
    indexed = StringIndexer(inputCol="job", outputCol="j").fit(sides).transform(sides)
    theirs = ChiSquareTest.test(VectorAssembler(inputCols=["j"], outputCol="f").transform(indexed), "f", "side").first()
    ours = drift.drift(sides.filter("side = 0"), sides.filter("side = 1"), ["job"]).first()
    assert ours["chi_squared"] == pytest.approx(theirs["statistics"][0])
    assert ours["chi_squared_pvalue"] == pytest.approx(theirs["pValues"][0])


def test_gate_edges(spark):
    rows = [("first", 0.8, None), ("weak", 0.7, None), ("equal", 0.808, 0.8), ("better", 0.81, 0.8), ("none", None, 0.8)]
    judged = registry.quality_gate(spark.createDataFrame(rows, "m STRING, candidate_f1 DOUBLE, champion_f1 DOUBLE"))
    passed = {r["m"]: r["evaluation_passed"] for r in judged.collect()}
    assert passed == {"first": 1, "weak": 0, "equal": 0, "better": 1, "none": 0}


def test_champion_without_metric_fails_the_job(spark):
    from pyspark.errors import PySparkException

    schema = "model_name STRING, challenger_version INT, candidate_f1 DOUBLE, champion_version INT, champion_f1 DOUBLE"
    with pytest.raises(PySparkException, match="no metric for champion version 1"):
        registry.promote_decision(spark.createDataFrame([("m", 2, 0.01, 1, None)], schema)).collect()
    first = registry.promote_decision(spark.createDataFrame([("m", 2, 0.01, None, None)], schema)).first()
    assert (first["promoted"], first["new_champion_version"]) == (1, 2)


def test_missing_metric_fails_the_job(spark):
    runs = spark.createDataFrame([("r1", "accuracy", 0.5)], "run_id STRING, metric STRING, value DOUBLE")
    from pyspark.errors import PySparkException

    with pytest.raises(PySparkException, match="no F1 metric"):
        registry.coalesce_metrics(runs, ["run_id"], "f1_weighted").collect()
    assert registry.coalesce_metrics(runs, ["run_id"], "f1_weighted", strict=False).first()["value"] is None
    assert registry.coalesce_metrics(runs, ["run_id"], "accuracy").first()["value"] == 0.5


def test_best_per_group_prunes_before_the_shuffle(spark, plan_of):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"), "id")
    plan = plan_of(registry.best_per_group(df, ["g"], "v", ["id"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan
