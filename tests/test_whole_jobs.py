"""Queries that must do their whole job, by the rows they handle."""

from __future__ import annotations

from pyspark.sql import functions as F

from galewright.plans import registered
from galewright.sources.fixtures import scored_events


def test_append_adds_a_second_log_to_the_whole_first(spark, tiny):
    log = scored_events(spark, tiny)
    written = registered()["sink_append"].build(spark, tiny)
    assert written.count() == 2 * log.count()
    assert written.groupBy("event_id").agg(F.count_distinct("inference_timestamp").alias("n")).filter("n <> 2").count() == 0


def test_the_whole_log_is_merged_with_its_baseline(spark, tiny):
    rows = scored_events(spark, tiny).count()
    merged = registered()["merge_on_category"].build(spark, tiny)
    sides = merged.groupBy("column_name").agg(F.sum("baseline_n").alias("b"), F.sum("current_n").alias("c")).collect()
    assert len(sides) == 3 and {r["c"] for r in sides} == {rows}
    assert all(0 < r["b"] < rows for r in sides)
