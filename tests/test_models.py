"""Fitted transformations, training, tuning and scoring."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from galewright.operators import prepare, project, scoring, training
from galewright.operators.metrics import averaged_metrics
from galewright.plans import modelling

CATEGORICAL, NUMERIC = modelling._CATEGORICAL, modelling._NUMERIC


@pytest.fixture(scope="module")
def parts(spark, tiny):
    return modelling.parts(spark, tiny)


@pytest.fixture(scope="module")
def forest(parts):
    return training.fit_model(parts["train"], "label", CATEGORICAL, NUMERIC, training.forest("label", trees=10, depth=6))


def test_forest_beats_the_majority_class(parts, forest):
    majority = parts["train"].groupBy("label").count().orderBy(F.desc("count")).first()["label"]
    guess = parts["test"].withColumn("guess", F.lit(majority))
    floor = averaged_metrics(guess, "label", "guess").first()["weighted_f1"]
    found = training.evaluate(training.apply_model(forest, parts["test"], NUMERIC), "label", "test_")
    values = {r["metric"]: r["value"] for r in found.collect()}
    assert values["test_weighted_f1"] > floor + 0.2 and values["test_roc_auc"] > 0.9
    assert set(values) == {f"test_{m}" for m in (*training.QUALITY, "roc_auc")}


def test_logistic_learns(parts):
    model = training.fit_model(parts["train"], "label", CATEGORICAL, NUMERIC, training.logistic("label", parts["train"].count()))
    scored = training.apply_model(model, parts["test"], NUMERIC)
    assert averaged_metrics(scored.withColumn("prediction", F.col("prediction").cast("int")), "label", "prediction").first()["weighted_f1"] > 0.85


def test_unknown_category_is_scored(parts, forest):
    strange = parts["test"].limit(3).withColumn("job", F.lit("never seen"))
    assert training.apply_model(forest, strange, NUMERIC).filter(F.col("prediction").isNull()).isEmpty()


def test_importances_carry_names(parts, forest):
    top = training.top_importances(forest, training.apply_model(forest, parts["test"], NUMERIC), 5).collect()
    assert len(top) == 5 and top[0]["importance"] >= top[-1]["importance"]
    assert any(r["feature"].startswith("scaled") for r in top)


def test_tuning_and_refit(spark, parts):
    trials = training.draw_trials(3, seed=7, forest_ranges={"depth": (3, 5, False), "trees": (5, 8, False), "leaf": (1, 5, False)})
    assert trials == training.draw_trials(3, seed=7, forest_ranges={"depth": (3, 5, False), "trees": (5, 8, False), "leaf": (1, 5, False)})
    result = training.tune(parts["train"], parts["validation"], "label", CATEGORICAL, NUMERIC, trials)
    rows = result.table.collect()
    assert [r["trial"] for r in rows] == [0, 1, 2]
    assert result.best.number == max(rows, key=lambda r: r["weighted_f1"])["trial"]
    _, table = training.refit_best(result.best, parts["train"], parts["test"], "label", CATEGORICAL, NUMERIC)
    names = {r["metric"] for r in table.collect()}
    assert {"training_weighted_f1", "test_weighted_f1"} <= names and len(names) == 18


def test_search_stays_in_its_ranges():
    for t in training.draw_trials(200, seed=1):
        ranges = training.LOGISTIC_RANGES if t.classifier == "LogisticRegression" else training.FOREST_RANGES
        assert all(ranges[k][0] <= v <= ranges[k][1] for k, v in t.params.items())


def test_model_inputs_and_required_columns(parts, forest):
    assert sorted(project.model_inputs(forest)) == sorted([*CATEGORICAL, *NUMERIC])
    wanted = {"job": "string", "balance": None}
    assert project.require_columns(parts["test"], wanted).columns == ["job", "balance"]
    with pytest.raises(project.MissingInput, match="nothing"):
        project.require_columns(parts["test"], {"nothing": None})
    with pytest.raises(project.MissingInput, match="int, not string"):
        project.require_columns(parts["test"], {"balance": "string"})


def test_inputs_come_from_the_model_or_the_preset(forest):
    from galewright.functions.rules import presets

    preset = presets()["v1_tier"]
    found = project.required_inputs(forest, preset)
    assert set(found) == {*CATEGORICAL, *NUMERIC} and found["duration_bucket"] == "string" and found["balance"] == "int"
    assert project.required_inputs(None, preset) == dict(preset.inputs)


def test_missing_category_gets_the_most_frequent_value(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel

    from galewright.operators.imputing import ModeImputer

    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)], "c STRING, d STRING")
    model = Pipeline(stages=[ModeImputer(inputCols=["c", "d"])]).fit(df)
    assert [tuple(r) for r in model.transform(df).filter("c = 'a'").collect()] == [("a", None)] * 3
    model.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model")).transform(df)
    assert again.filter("c IS NULL").isEmpty() and again.filter("d IS NULL").count() == 5


def test_label_is_no_feature(parts):
    with pytest.raises(ValueError):
        project.features_without_label(parts["test"], "contact_key", ["label", "job"], "label")


def test_expression_and_batches_agree(spark, tiny):
    from galewright.sources.fixtures import contacts

    model = modelling.contact_model()
    gaps = contacts(spark, tiny).withColumn("balance", F.when(F.col("contact_key") % 5 > 0, F.col("balance")))
    both = scoring.batch_score(scoring.score_linear(gaps, model), lambda: model, model.inputs, "batch_prediction")
    assert both.filter(~F.col("prediction").eqNullSafe(F.col("batch_prediction"))).isEmpty()
    assert both.filter(F.col("prediction").isNull()).count() == both.filter("balance IS NULL").count() > 0


def test_one_hot_of_unknown_values(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c STRING")
    fitted = prepare.fit_categories(df, "c")
    assert sorted(map(tuple, fitted.collect())) == [("a", 0), ("b", 1)]
    indexed = prepare.index_category(df, "c", fitted.filter("category = 'b'"))
    assert {(r["c"], r["c_index"]) for r in indexed.collect()} == {("a", None), ("b", 1), (None, None)}
    rows = prepare.one_hot(df, "c", ["a"]).select("c_a").collect()
    assert [r[0] for r in rows] == [1, 0, 0]
    with pytest.raises(PySparkException, match="unknown category"):
        prepare.one_hot(df, "c", ["a"], unknown="error").collect()


def test_imputation_uses_the_fitted_statistics(spark):
    fitted = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (None, "b"), (2.0, "a")], "x DOUBLE, c STRING")
    rows = prepare.impute(spark.createDataFrame([(None, None)], "x DOUBLE, c STRING"), ["x"], ["c"], fitted).first()
    assert tuple(rows) == (2.0, "a")


def test_scaling_a_constant_only_centres_it(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x DOUBLE, c DOUBLE")
    assert [tuple(r) for r in prepare.standard_scale(df, ["x", "c"]).select("x_z", "c_z").collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_transforming_needs_no_join(spark, tiny, plan_of):
    from galewright.sources.fixtures import table

    orders = table(spark, tiny, "orders")
    for df in (
        prepare.impute(orders, ["o_totalprice"], ["o_orderpriority"]),
        prepare.standard_scale(orders, ["o_totalprice"]),
    ):
        assert "Join" not in plan_of(df)


def test_scoring_by_alias_stamps_stores_and_refuses(spark, parts, forest, tmp_path):
    from galewright.sources.snapshots import SnapshotTable

    root, output = str(tmp_path / "models"), SnapshotTable(spark, str(tmp_path / "scored"))
    scoring.save_model(forest, root, "m", 3)
    aliases = spark.createDataFrame([("m", "champion", 3), ("other", "champion", 9)], "model_name STRING, alias STRING, version INT")
    rows = training.numeric_inputs(parts["test"], NUMERIC)
    inputs = {c: None for c in (*CATEGORICAL, *NUMERIC)}
    counts = scoring.score_with_alias(rows, root, aliases, "m", "champion", inputs, ["contact_key"], output)
    assert sum(r["row_count"] for r in counts.collect()) == rows.count()
    stored = output.as_of()
    assert stored.columns == ["contact_key", "prediction", *scoring.STAMPS]
    assert tuple(stored.select("model_name", "model_alias", "model_version").distinct().first()) == ("m", "champion", "3")
    with pytest.raises(ValueError, match="no alias"):
        scoring.score_with_alias(rows, root, aliases, "m", "challenger", inputs, ["contact_key"], output)
    with pytest.raises(project.MissingInput):
        scoring.score_with_alias(rows.drop("balance"), root, aliases, "m", "champion", inputs, ["contact_key"], output)
    with pytest.raises(Exception, match="exists"):
        scoring.save_model(forest, root, "m", 3)
