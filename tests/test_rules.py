"""Every bucket edge and NULL, for all three rule sets."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from galewright.functions import rules

SCHEMA = (
    "id INT, age INT, job STRING, balance INT, housing STRING, loan STRING, duration BIGINT, campaign INT, pdays INT, previous INT, y STRING"
)
DEFAULT = dict(id=0, age=40, job="x", balance=5, housing="no", loan="no", duration=90, campaign=1, pdays=-1, previous=0, y="no")


def derive(spark, preset, **changes):
    row = DEFAULT | changes
    df = spark.createDataFrame([tuple(row[f.split()[0]] for f in SCHEMA.split(", "))], SCHEMA)
    found = rules.presets()[preset].apply(df).collect()
    return found[0].asDict() if found else None


def check_column(spark, feature, column, cases, preset_names):
    """``cases``: (input, expected per preset); one Spark job per preset."""
    for position, name in enumerate(preset_names):
        rows = [tuple({**DEFAULT, column: value, "id": i}[f.split()[0]] for f in SCHEMA.split(", ")) for i, (value, _) in enumerate(cases)]
        df = rules.presets()[name].apply(spark.createDataFrame(rows, SCHEMA))
        found = {r["id"]: r[feature] for r in df.select("id", feature).collect()}
        wanted = {i: e[position] for i, (_, e) in enumerate(cases) if e[position] is not DROPPED}
        assert found == pytest.approx(wanted) if feature == "recency_score" and position == 2 else found == wanted, name


DROPPED = object()
ALL = ("v1_tier", "v1_cut", "v2_ratio")


def test_age(spark):
    check_column(spark, "age_group", "age", [
        (18, ("young", "young", "young")), (29, ("young", "young", "young")), (30, ("adult", "young", "young")),
        (31, ("adult", "adult", "middle")), (45, ("middle_age", "adult", "middle")), (50, ("middle_age", "middle_age", "middle")),
        (51, ("middle_age", "middle_age", "senior")), (60, ("senior", "middle_age", "senior")), (65, ("senior", "senior", "senior")),
        (66, ("senior", "senior", "elderly")), (120, ("senior", "senior", "elderly")), (121, ("senior", "nan", "elderly")),
        (17, (DROPPED, DROPPED, "young")), (None, (DROPPED, DROPPED, "elderly")),
    ], ALL)


def test_balance(spark):
    check_column(spark, "balance_tier", "balance", [
        (-1, ("negative", "negative", "negative")), (0, ("low", "negative", "low")), (1, ("low", "low", "low")),
        (300, ("medium", "low", "low")), (301, ("medium", "medium", "low")), (499, ("medium", "medium", "low")),
        (500, ("medium", "medium", "medium")), (1000, ("high", "medium", "medium")), (1001, ("high", "high", "medium")),
        (2000, ("high", "high", "medium")), (2001, ("high", "high", "high")), (999999, ("high", "high", "high")),
        (1000000, ("high", "nan", "high")), (-999999, ("negative", "nan", "negative")), (None, ("high", "nan", "high")),
    ], ALL)


def test_duration(spark):
    check_column(spark, "duration_bucket", "duration", [
        (0, ("short", "nan", "very_short")), (59, ("short", "short", "very_short")), (60, ("short", "short", "short")),
        (120, ("medium", "short", "short")), (121, ("medium", "medium", "short")), (180, ("medium", "medium", "medium")),
        (300, ("long", "medium", "medium")), (301, ("long", "long", "medium")), (500, ("long", "long", "medium")),
        (501, ("long", "long", "long")), (None, ("long", "nan", "long")),
    ], ALL)


def test_campaign(spark):
    check_column(spark, "contact_intensity", "campaign", [
        (1, ("low", "low", 1.0)), (2, ("high", "high", 2.0)), (4, ("high", "high", 4.0)), (None, ("high", "high", None)),
    ], ALL)
    assert derive(spark, "v2_ratio", campaign=3, previous=2)["contact_intensity"] == 1.0
    assert derive(spark, "v2_ratio", campaign=3, previous=-1)["contact_intensity"] is None


def test_pdays(spark):
    cases = [
        (-1, (0, 0, 0.0)), (0, (3, 3, 1.0)), (30, (3, 3, 1 / 31)), (31, (2, 2, 1 / 32)), (180, (2, 2, 1 / 181)),
        (181, (1, 1, 1 / 182)), (-5, (3, 3, -0.25)),
    ]
    check_column(spark, "recency_score", "pdays", cases, ALL)
    flags = [(v, (0, 0, 0) if v == -1 else (1, 1, 1)) for v, _ in cases] + [(None, (1, 1, 0))]
    check_column(spark, "was_previously_contacted", "pdays", flags, ALL)
    assert derive(spark, "v1_tier", pdays=None)["recency_score"] == 1
    assert derive(spark, "v2_ratio", pdays=None)["recency_score"] is None


@pytest.mark.parametrize(
    "balance, housing, loan, tier, flag",
    [(-1, "no", "no", "high", 0), (5, "yes", "yes", "high", 1), (5, "yes", "no", "medium", 0), (5, "no", "no", "low", 0)],
)
def test_financial_stress(spark, balance, housing, loan, tier, flag):
    changes = dict(balance=balance, housing=housing, loan=loan)
    assert derive(spark, "v1_tier", **changes)["financial_stress"] == tier
    assert derive(spark, "v1_cut", **changes)["financial_stress"] == tier
    assert derive(spark, "v2_ratio", **changes)["financial_stress"] == flag


def test_right_closed_bands_agree_with_pandas_cut(spark):
    values = list(range(-2, 130))
    labels = ["young", "adult", "middle_age", "senior"]
    wanted = pd.cut(pd.Series(values), bins=[0, 30, 45, 60, 120], labels=labels).astype(str).tolist()
    df = spark.createDataFrame([(v,) for v in values], "age INT")
    assert [r[0] for r in df.select(rules.band("age", rules.CUT_AGE)).collect()] == wanted


def test_preset_needs_its_inputs(spark):
    with pytest.raises(ValueError, match="duration"):
        rules.presets()["v1_tier"].apply(spark.range(1).withColumn("age", F.lit(30)))


def test_declared_feature_types_hold(spark):
    for name, preset in rules.presets().items():
        df = preset.apply(spark.createDataFrame([], SCHEMA))
        stored = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        assert {c: stored[c] for c in rules.FEATURE_NAMES} == dict(preset.feature_types), name


def test_features_stay_in_the_jvm(spark, sf, plan_of):
    from galewright.sources.fixtures import contacts

    for preset in rules.presets().values():
        plan = plan_of(preset.apply(contacts(spark, sf)))
        assert "Python" not in plan and "ArrowEval" not in plan
