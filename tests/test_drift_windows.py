"""Windowed drift from the categories that a window has, against cells for all categories of both sides."""

from __future__ import annotations

import random
from collections import Counter
from math import log2, sqrt

import pytest
from pyspark.sql import functions as F

from galewright.operators import drift

SCHEMA = "t TIMESTAMP_NTZ, m INT, s STRING, c STRING"


def plain(base: Counter, now: Counter) -> dict[str, float]:
    nb, nc = base.total(), now.total()
    js = tv = linf = chi2 = 0.0
    for c in base | now:
        p, q = base[c] / nb, now[c] / nc
        for share in (p, q):
            js += share * log2(2 * share / (p + q)) if share else 0
        tv, linf = tv + abs(p - q) / 2, max(linf, abs(p - q))
        for seen, side in ((base[c], nb), (now[c], nc)):
            expected = (base[c] + now[c]) * side / (nb + nc)
            chi2 += (seen - expected) ** 2 / expected
    return {"js_distance": sqrt(max(js / 2, 0)), "tv_distance": tv, "l_infinity": linf, "chi_squared": chi2}


@pytest.fixture(scope="module")
def sides(spark):
    """Many categories of very uneven shares; some windows have the frequent ones, some only rare or new ones."""
    draw = random.Random(2)
    names = [f"c{i}" for i in range(400)] + [None]
    base = [("2024-01-01 00:00:00", 1, draw.choice("xy"), draw.choices(names, [1 / (i + 1) for i in range(401)])[0]) for _ in range(3000)]
    now = []
    for day, some in enumerate((names, names[3:], names[:2], names[200:], ["new", "c0"], names[:1] + names[2:])):
        for _ in range((900, 300, 40, 200, 5, 2000)[day]):
            weights = [1 / (names.index(c) + 1) if c in names else 1 for c in some]
            now.append((f"2024-01-1{day} 05:00:00", draw.choice([1, 2]), draw.choice("xyz"), draw.choices(some, weights)[0]))
    frames = []
    for rows in (base, now):
        df = spark.createDataFrame(rows, "t STRING, m INT, s STRING, c STRING")
        frames.append(df.withColumn("t", F.col("t").cast("timestamp_ntz")).select("t", "m", "s", "c"))
    return frames


def test_equals_cells_of_all_categories(spark, sides):
    base, now = sides
    text = lambda v: "null" if v is None else v
    wanted_base, wanted_now = {}, {}
    for row in base.collect():
        for slice_ in (":all", row["s"]):
            wanted_base.setdefault(slice_, Counter())[text(row["c"])] += 1
    for row in now.collect():
        for slice_ in (":all", row["s"]):
            wanted_now.setdefault((row["t"].day, row["m"], slice_), Counter())[text(row["c"])] += 1
    wanted = {}
    for (day, m, slice_), counts in wanted_now.items():
        if slice_ in wanted_base:
            for metric, value in plain(wanted_base[slice_], counts).items():
                wanted[day, m, slice_, metric] = value
    rows = drift.drift_metrics(base, now, ["c"], "t", "m", ["s"]).filter("metric <> 'chi_squared_pvalue'")
    assert {r["value"] for r in rows.filter("slice_value = 'z'").collect()} == {None}  # a slice of the log only
    rows = rows.filter("baseline_rows > 0").collect()
    found = {(r["window_start"].day, r["m"], r["slice_value"], r["metric"]): r["value"] for r in rows}
    assert found.keys() == wanted.keys()
    for key, value in wanted.items():
        assert found[key] == pytest.approx(value, abs=1e-9), key


def test_cells_do_not_grow_with_the_baseline(spark, monkeypatch):
    """Ten windows of one category each, against a baseline of 5,000 categories, make ten cells."""
    written = []

    def noted(df, label):
        out = original(df, label)
        written.append((label, out.count()))
        return out

    original = drift.materialize
    monkeypatch.setattr(drift, "materialize", noted)
    base = spark.range(5000).select(F.lit("2024-01-01").cast("timestamp_ntz").alias("t"), F.lit(1).alias("m"), F.col("id").cast("string").alias("c"))
    now = spark.range(10).select(F.expr("timestampadd(DAY, id, timestamp_ntz'2024-02-01 00:00:00')").alias("t"), F.lit(1).alias("m"), F.lit("7").alias("c"))
    rows = drift.drift_metrics(base, now, ["c"], "t", "m").filter("metric = 'tv_distance'").collect()
    assert [r["value"] for r in rows] == pytest.approx([1 - 1 / 5000] * 10)
    assert dict(written)["drift-cells"] == 10
