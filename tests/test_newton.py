"""Logistic regression by Newton steps: the optimum, its certificate, and many models in the same passes."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from galewright.operators import newton
from galewright.operators.metrics import averaged_metrics, roc_auc
from galewright.plans import modelling

CATEGORICAL, NUMERIC = modelling._CATEGORICAL, modelling._NUMERIC


@pytest.fixture(scope="module")
def train(spark, tiny):
    return modelling.parts(spark, tiny)["train"]


@pytest.fixture(scope="module")
def fitted(train):
    design = newton.Design.fitted(train, CATEGORICAL, NUMERIC)
    rows = newton.design_rows(train, design, "label")
    return design, rows, newton.fit_many(rows, design, [0.01, 1.0, 10.0])


def plain(rows, d, c):
    """The same optimum by plain Newton steps on one matrix."""
    table = rows.toPandas()
    y, w = table["y"].to_numpy(), table["w"].to_numpy()
    x = np.column_stack([np.ones(len(y)), table[[f"x{i}" for i in range(d - 1)]].to_numpy()])
    penalty = np.full(d, 1 / c)
    penalty[0] = 0
    beta = np.zeros(d)
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ beta))
        curvature = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        beta = beta - 0.7 * np.linalg.lstsq(curvature, x.T @ (w * (p - y)) + penalty * beta, rcond=None)[0]
    return beta


def test_coefficients_are_the_optimum_in_few_passes(fitted):
    design, rows, models = fitted
    for model, c in zip(models, (0.01, 1.0, 10.0)):
        assert model.passes < 15
        assert np.allclose(model.coefficients, plain(rows, len(design.names), c), atol=1e-5)


def test_models_of_shared_passes_equal_models_alone(fitted):
    design, rows, models = fitted
    for model, c in zip(models, (0.01, 1.0, 10.0)):
        assert np.allclose(newton.fit_many(rows, design, [c])[0].coefficients, model.coefficients, atol=1e-7)


def test_score_equations_hold(fitted):
    _, rows, models = fitted
    found = {r["feature"]: r["fitted"] for r in newton.score_equations(models[1], rows, 1.0).collect()}
    weighed = rows.agg(F.sum(F.col("w") * F.col("y"))).first()[0]
    assert found[newton.INTERCEPT] == pytest.approx(weighed, abs=1e-6)
    assert sum(v for k, v in found.items() if k.startswith("job=")) == pytest.approx(weighed, abs=1e-6)


def test_the_model_scores_as_an_expression(spark, tiny, plan_of, fitted):
    test = modelling.parts(spark, tiny)["test"]
    scored = fitted[2][1].apply(test)
    assert "Python" not in plan_of(scored) and "Arrow" not in plan_of(scored)
    assert roc_auc(scored, "label", "score").first()["roc_auc"] > 0.9
    flat = scored.select("label", F.col("prediction").cast("int").alias("prediction"))
    assert averaged_metrics(flat, "label", "prediction").first()["weighted_f1"] > 0.8


def test_gaps_and_unknown_values_have_a_score(spark, fitted):
    odd = spark.createDataFrame([(None, "?", "yes", None, None, 1.0, None, 2.0)], "job STRING, housing STRING, loan STRING, duration_bucket STRING, balance DOUBLE, duration DOUBLE, campaign DOUBLE, previous DOUBLE")
    assert 0 < fitted[2][1].apply(odd).first()["score"] < 1


def test_rows_without_label_and_constant_numbers(spark):
    rows = [(float(i % 7), "a" if i % 2 else "b", 1 if i % 3 == 0 else 0, 5.0) for i in range(200)] + [(1.0, "a", None, 5.0), (None, None, 1, None)]
    df = spark.createDataFrame(rows, "x DOUBLE, c STRING, y INT, k DOUBLE")
    model = newton.fit_logistic(df, "y", ["c"], ["x", "k"])
    assert model.design.names == [newton.INTERCEPT, "c=a", "c=b", "x", "k"] and abs(model.coefficients[-1]) < 1e-9


def test_separable_rows_have_an_optimum_by_the_penalty(spark):
    df = spark.createDataFrame([(float(i), int(i >= 10)) for i in range(20)], "x DOUBLE, y INT")
    model = newton.fit_logistic(df, "y", [], ["x"], c=100.0)
    assert model.passes < 40 and model.apply(df).where("prediction <> y").count() == 0


def test_blocks_hold_the_rows(spark, fitted, monkeypatch):
    design, rows, models = fitted
    d, ones = len(design.names), len(design.categories)
    wanted = sorted(map(tuple, rows.select("y", "w", *[f"x{i}" for i in range(d - 1)]).collect()))
    for bits, block in ((62, 65_536), (5, 100)):
        monkeypatch.setattr(newton, "BITS", bits)
        monkeypatch.setattr(newton, "BLOCK", block)
        packed = newton._blocks(rows, design).collect()
        assert max(b["n"] for b in packed) <= max(block // d, 1) and len(packed) < len(wanted)
        found = []
        for b in packed:
            matrix, y, w = newton._unpacked(b["n"], b["ones"], b["numbers"], ones)
            assert (matrix[:, 0] == 1).all()
            found += map(tuple, np.column_stack([y, w, matrix[:, 1:]]).tolist())
        assert sorted(found) == wanted


def test_a_pass_reads_blocks_and_leaves_out_ready_models(fitted, monkeypatch):
    design, rows, models = fitted
    seen, sums = [], newton._sums
    monkeypatch.setattr(newton, "_sums", lambda blocks, tried, ones: seen.append((blocks.columns, len(tried))) or sums(blocks, tried, ones))
    again = newton.fit_many(rows, design, [1e-6, 10.0])
    assert seen[0] == (["n", "ones", "numbers"], 2) and seen[-1][1] == 1 and len(seen) == again[1].passes > again[0].passes
    assert np.allclose(again[1].coefficients, models[2].coefficients, atol=1e-9)
