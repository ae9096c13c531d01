"""Types of ragged text, bootstrap weights and bounds, and distinct counts from merged sketches."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from galewright.operators import profile, registry
from galewright.session import fresh_path
from galewright.sources import inference


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("7", "int"), (" -12 ", "int"), ("2147483648", "bigint"), ("-2147483648", "int"), ("1" * 19, "double"), ("1.", "double"), (".5", "double"),
        ("1e9", "double"), ("1,5", "string"), ("2024-02-29", "date"), ("2023-02-29", "string"), ("2024-02-29 10:00:00", "timestamp_ntz"),
        ("2024-02-29T10:00:00.123", "timestamp_ntz"), ("True", "boolean"), ("yes", "string"), ("", None), ("  ", None), (None, None), ("NaN", "string"),
    ],
)
def test_narrowest(spark, text, wanted):
    assert spark.createDataFrame([(text,)], "v STRING").select(inference.narrowest(F.col("v"))).first()[0] == wanted


def test_ragged_file_is_typed_and_shows_the_row_that_widened_it(spark, tmp_path):
    lines = ["k;a;b;c;d;e", "1;1;1;2024-01-01;true;", "2;2;2.5;2024-01-02 10:00:00;false;", "3;x;3;;TRUE;", "4;4;5000000000;2024-01-04;;"]
    (tmp_path / "rows.csv").write_text("\n".join(lines))
    texts = inference.read_texts(spark, str(tmp_path / "rows.csv"))
    report = inference.type_report(texts, "k")
    met = {(r["column_name"], r["narrowest"]): (r["row_count"], r["first_key"]) for r in report.collect()}
    assert met["a", "string"] == (1, "3") and met["a", "int"] == (3, "1") and met["b", "bigint"] == (1, "4")
    rows = inference.typed(texts, report)
    assert dict(rows.dtypes) == {"k": "string", "a": "string", "b": "double", "c": "timestamp_ntz", "d": "boolean", "e": "string"}
    assert [r["b"] for r in rows.orderBy("k").collect()] == [1.0, 2.5, 3.0, 5e9]


def test_report_of_no_rows_is_empty(spark):
    assert inference.type_report(spark.createDataFrame([], "k STRING, a STRING"), "k").count() == 0


def test_weights_are_poisson(spark):
    drawn = spark.range(20_000).select(registry.poisson_weight("id", F.lit(3)).alias("n"))
    shares = {r["n"]: r["count"] / 20_000 for r in drawn.groupBy("n").count().collect()}
    assert shares[0] == pytest.approx(0.3679, abs=0.012) and shares[1] == pytest.approx(0.3679, abs=0.012) and shares[2] == pytest.approx(0.1839, abs=0.01)
    first = int(hashlib.md5(b"0|3").hexdigest()[:8], 16)
    assert drawn.first()["n"] == sum(first >= v for v in registry._POISSON)


def test_bound_lies_below_the_gain_and_narrows_with_rows(spark):
    def bounds(n):
        rows = spark.range(n).select("id", F.lit("s").alias("segment"), (F.col("id") % 2).alias("v"), (F.col("id") % 3 == 0).cast("int").alias("y"))
        better = F.when((F.col("v") == 1) & (F.col("id") % 5 == 0) | (F.col("v") == 0) & (F.col("id") % 4 == 0), 1 - F.col("y")).otherwise(F.col("y"))
        return registry.segment_gain_bounds(rows.withColumn("p", better), "id", "segment", "v", 0, 1, "y", "p").first()

    few, many = bounds(400), bounds(20_000)
    assert few["gain_low"] < few["gain"] and many["gain"] - many["gain_low"] < few["gain"] - few["gain_low"]


def test_a_segment_without_one_version_has_no_gain(spark):
    rows = spark.createDataFrame([(1, "a", 1, 1, 1), (2, "a", 2, 1, 0), (3, "b", 1, 1, 1)], "id INT, s STRING, v INT, y INT, p INT")
    found = {r["s"]: r for r in registry.segment_gain_bounds(rows, "id", "s", "v", 1, 2, "y", "p").collect()}
    assert found["a"]["gain"] == -1.0 and found["b"]["candidate_f1"] is None and found["b"]["gain_low"] is None


def test_merged_sketches_stay_within_their_error(spark):
    log = spark.range(200_000).select(
        F.expr("timestampadd(HOUR, id % 240, timestamp_ntz'2024-01-01 00:00:00')").alias("t"), F.lit(1).alias("m"), (F.col("id") % 50_000).alias("u")
    )
    path = fresh_path(spark, "sketches")
    profile.daily_sketches(log, "t", "m", ["u"], size=12).write.parquet(path)
    kept = spark.read.parquet(path)
    assert kept.count() == 10
    found = profile.merged_distinct(kept, ["m"], size=12).first()["distinct_count"]
    assert abs(found / 50_000 - 1) < 4 / 2**6  # four standard errors


def test_the_weights_of_few_bytes_are_dealt_to_all_tasks(spark, plan_of):
    rows = spark.range(1000).coalesce(1).selectExpr("id", "'s' AS segment", "id % 2 AS v", "1 AS y", "1 AS p")
    plan = plan_of(registry.segment_gain_bounds(rows, "id", "segment", "v", 0, 1, "y", "p"))
    assert "REPARTITION_BY_NUM" in plan[plan.index("Generate explode(") :]
