"""Forests grown from counted rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from galewright.operators import forest, prepare, training
from galewright.operators.metrics import averaged_metrics
from galewright.plans import modelling

CATEGORICAL, NUMERIC = modelling._CATEGORICAL, modelling._NUMERIC


@pytest.fixture(scope="module")
def parts(spark, tiny):
    return modelling.parts(spark, tiny)


def f1(scored):
    return averaged_metrics(scored.withColumn("prediction", F.col("prediction").cast("int")), "label", "prediction").first()["weighted_f1"]


def test_is_as_good_as_the_forest_of_spark(parts):
    theirs = training.fit_model(parts["train"], "label", CATEGORICAL, NUMERIC, training.forest("label", trees=30, depth=8))
    ours = forest.fit_forest(parts["train"], "label", CATEGORICAL, NUMERIC, trees=30, depth=8)
    assert f1(ours.apply(parts["test"])) > f1(training.apply_model(theirs, parts["test"], NUMERIC)) - 0.03


def test_equal_rows_are_counted_once_and_weigh_as_many(spark, parts):
    once = parts["train"].where("contact_key % 2 = 0")
    bins = forest.Bins.fitted(once, CATEGORICAL, NUMERIC)
    many = once.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("copy")
    a, b = (forest.counted_rows(rows, bins, "label") for rows in (once, many))
    assert a.count() == b.count()
    assert 50 * a.agg(F.sum("n")).first()[0] == b.agg(F.sum("n")).first()[0] == many.count()
    assert forest.fit_counted(b, bins, 2, 3).counted_predictions(b).count() == many.count()


def test_a_tree_grows_as_said(spark):
    rows = spark.range(4000).selectExpr("CAST(id % 100 AS INT) AS x", "CASE WHEN id % 3 = 0 THEN 'a' END AS c", "CAST(id % 100 >= 40 AS INT) AS label")
    model = forest.fit_forest(rows, "label", ["c"], ["x"], trees=5, depth=4, leaf=100)
    assert f1(model.apply(rows)) > 0.95
    for tree in model.trees:
        assert len(tree.feature) <= 2**5 - 1 and (tree.left[tree.feature >= 0] > 0).all() and ((tree.share >= 0) & (tree.share <= 1)).all()
    strange = spark.createDataFrame([(None, "never seen"), (float("nan"), None)], "x DOUBLE, c STRING")
    assert all(0 <= r["score"] <= 1 for r in model.apply(strange).collect())


def test_best_split_by_hand():
    counts = np.zeros((1, 1, forest.BINS, 2))
    counts[0, 0, 3], counts[0, 0, 9] = (6, 1), (0, 5)
    found = forest._best_splits(counts, np.array([[7]]), (1.0, 1.0), 1)
    assert found.tolist() == [[7, 3, 6, 6, 6, 1]]
    assert forest._best_splits(counts, np.array([[7]]), (1.0, 1.0), 6)[0, 0] == -1  # five rows on the right


def test_a_forest_is_the_same_again(parts):
    a, b = (forest.fit_forest(parts["train"], "label", CATEGORICAL, NUMERIC, trees=3, depth=4) for _ in range(2))
    assert len(a.trees) == len(b.trees) == 3 and {len(t.feature) for t in a.trees} != {1}


def test_no_row_is_shuffled_by_class(spark, plan_of):
    rows = spark.range(1000).selectExpr("id", "CAST(id % 2 AS INT) AS label")
    plan = plan_of(prepare.with_class_weight(rows, "label"))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("trial", [training.Trial(0, "RandomForest", {"trees": 4, "depth": 5, "leaf": 2}), training.Trial(1, training.LOGISTIC, {"C": 1.0, "tol": 1e-4})])
def test_refit_takes_the_searchs_own_models(parts, trial):
    model, table = training.refit_best(trial, parts["train"], parts["test"], "label", CATEGORICAL, NUMERIC)
    assert isinstance(model, forest.Forest) == (trial.number == 0)
    values = {r["metric"]: r["value"] for r in table.collect()}
    assert values["test_weighted_f1"] > 0.7 and len(values) == 18


def test_odd_labels(spark):
    rows = spark.range(20).selectExpr("CAST(id AS INT) AS x", "CAST(NULL AS STRING) AS c", "CAST(id % 3 AS INT) AS label")
    with pytest.raises(ValueError, match="not 0 or 1"):
        forest.fit_forest(rows, "label", ["c"], ["x"], trees=1, depth=2)
    ones = forest.fit_forest(rows.where("label = 1"), "label", ["c"], ["x"], trees=2, depth=2)
    assert {r["score"] for r in ones.apply(rows).collect()} == {1.0}
    assert forest.fit_forest(rows.withColumn("label", F.lit(None).cast("int")), "label", ["c"], ["x"], trees=1, depth=1).apply(rows).count() == 20


def test_trees_finished_in_a_task_and_forests_grown_together_are_the_same(parts, monkeypatch):
    bins = forest.Bins.fitted(parts["train"], CATEGORICAL, NUMERIC)
    rows = forest.counted_rows(parts["train"], bins, "label")
    wanted = [{"trees": 3, "depth": 6, "leaf": 2}, {"trees": 5, "depth": 3, "leaf": 2}, {"trees": 2, "depth": 4, "leaf": 1}]
    together, passes, level = forest.fit_many(rows, bins, wanted), [], forest._level
    monkeypatch.setattr(forest, "_level", lambda *given: passes.append(len(given[2])) or level(*given))
    for finished, most in ((0, 13), (500, 13), (32_768, 3)):
        monkeypatch.setattr(forest, "FINISHED", finished)
        passes.clear()
        alone = [forest.fit_counted(rows, bins, **w) for w in wanted]
        assert len(passes) <= most
        for a, b in zip(together, alone):
            assert len(a.trees) == len(b.trees)
            for s, t in zip(a.trees, b.trees):
                inner = s.feature >= 0
                assert (s.feature == t.feature).all() and (s.cut[inner] == t.cut[inner]).all() and (s.left[inner] == t.left[inner]).all()
                assert (s.share == t.share).all()


def test_forests_of_a_search_share_their_passes(parts, monkeypatch):
    passes, level = [], forest._level
    monkeypatch.setattr(forest, "_level", lambda *given: passes.append(len(given[2])) or level(*given))
    trials = [training.Trial(i, "RandomForest", {"trees": 4 - i, "depth": 3 + i, "leaf": 2}) for i in range(3)]
    found = training.tune(parts["train"], parts["validation"], "label", CATEGORICAL, NUMERIC, trials).table
    assert len(passes) <= 5 and max(passes) == 4 and found.count() == 3
