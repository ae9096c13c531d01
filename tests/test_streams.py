"""Streams over several files and batches give the batch result; replays change nothing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from galewright.operators.metrics import quality_columns
from galewright.operators.profile import windowed
from galewright.session import fresh_path, path_exists
from galewright.sources.fixtures import as_scored, scored_events, table
from galewright.sources.snapshots import SnapshotTable
from galewright.streaming import log, newest


@pytest.fixture(scope="module")
def folder(spark, tiny):
    """The events as five files in time order."""
    path = fresh_path(spark, "events")
    events = table(spark, tiny, "events")
    events.repartitionByRange(5, "ts").write.parquet(path)
    return path


def stream(spark, tiny, folder):
    return log.read_stream(spark, folder, table(spark, tiny, "events").schema, "*.parquet", files_per_batch=1)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_daily_profile_equals_batch(spark, tiny, folder, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        daily = log.daily_profile(as_scored(stream(spark, tiny, folder)), "inference_timestamp", "model_version", "y_flag", "prediction", "40 days")
        profile = SnapshotTable(spark, fresh_path(spark, "daily"))
        log.run_available(daily, log.upsert_sink(profile, ["window_start", "window_end", "model_version"], "daily"), fresh_path(spark, "stream"), mode="update")
        names = ["window_start", "window_end", "model_version", "row_count", "accuracy", "f1"]
        found = sorted(tuple(r) for r in profile.as_of().select(names).collect())
        batch = windowed(scored_events(spark, tiny), "inference_timestamp").groupBy(*names[:3]).agg(
            F.count(F.lit(1)).alias("row_count"), *[c.alias(n) for n, c in quality_columns("y_flag", "prediction").items()]
        )
        assert found == sorted(tuple(r) for r in batch.select(names).collect())
        assert profile.latest() >= 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_feature_upsert_over_batches(spark, tiny, folder):
    features = SnapshotTable(spark, fresh_path(spark, "newest"))
    arriving = stream(spark, tiny, folder).select("user_id", "ts", "value")
    checkpoint = fresh_path(spark, "checkpoint")
    log.run_available(arriving, log.upsert_sink(features, ["user_id"], "newest", "ts"), checkpoint)
    newest = table(spark, tiny, "events").groupBy("user_id").agg(F.max("ts").alias("ts"))
    found = features.as_of()
    assert found.count() == newest.count() == found.join(newest, ["user_id", "ts"]).count()
    version = features.latest()
    log.run_available(arriving, log.upsert_sink(features, ["user_id"], "newest", "ts"), checkpoint)
    assert features.latest() == version


def test_a_batch_delivered_twice_is_committed_once(spark):
    target = SnapshotTable(spark, fresh_path(spark, "twice"))
    target.overwrite(spark.createDataFrame([(1, 0)], "k INT, y INT"))
    sink = log.backfill_sink(target, ["k"], ["y"], "labels")
    late = spark.createDataFrame([(1, 1), (5, 1)], "k INT, y INT")
    sink(late, 0)
    sink(late, 0)
    assert target.latest() == 1 and [tuple(r) for r in target.as_of().collect()] == [(1, 1)]


def test_empty_batch_writes_no_version(spark):
    target = SnapshotTable(spark, fresh_path(spark, "empty"))
    log.upsert_sink(target, ["k"], "s")(spark.createDataFrame([], "k INT, y INT"), 0)
    assert not target.exists()


def test_newest_per_key_breaks_ties_the_same_way(spark):
    rows = [(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, 1, None)]
    df = spark.createDataFrame(rows, "k INT, t INT, v STRING")
    for n in (1, 4):
        found = {r["k"]: r["v"] for r in log.newest_per_key(df.repartition(n), ["k"], "t").collect()}
        assert found == {1: "b", 2: None}


def _orders(spark, tiny):
    """The same events as files in time order, against it, and with every file there twice."""
    events = table(spark, tiny, "events").select("user_id", "ts", "value", "event_id")
    cut = events.repartitionByRange(3, "ts").withColumn("part", F.spark_partition_id()).persist()
    for order in ((0, 1, 2), (2, 0, 1, 0, 2)):
        path = fresh_path(spark, "orders")
        for part in order:
            cut.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(path)
        yield path, events
    cut.unpersist()


def test_newest_rows_resolve_alike_in_any_order(spark, tiny):
    for path, events in _orders(spark, tiny):
        stream = log.read_stream(spark, path, events.schema, "*.parquet", files_per_batch=1)
        out, checkpoint = fresh_path(spark, "newest"), fresh_path(spark, "checkpoint")
        newest.append_newest(stream, out, checkpoint, ["user_id"], "ts")
        found = newest.newest(spark, out, events.schema, ["user_id"], "ts")
        wanted = log.newest_per_key(events, ["user_id"], "ts")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.select(found.columns).collect()))
        written = spark.read.parquet(out).count()
        newest.append_newest(stream, out, checkpoint, ["user_id"], "ts")  # nothing new has come
        assert spark.read.parquet(out).count() == written < events.count()


def test_a_batch_writes_only_its_own_keys(spark, tiny):
    schema = "k INT, t INT, v STRING"
    path, out, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "checkpoint"))

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        before = set(spark.read.schema(schema).parquet(out).inputFiles()) if path_exists(spark, out) else set()
        stream = log.read_stream(spark, path, spark.createDataFrame([], schema).schema, "*.parquet")
        newest.append_newest(stream, out, checkpoint, ["k"], "t")
        new = set(spark.read.schema(schema).parquet(out).inputFiles()) - before
        return sorted(map(tuple, spark.read.schema(schema).parquet(*new).collect())) if new else []

    assert arrive([(k, 5, "first") for k in range(100)]) == [(k, 5, "first") for k in range(100)]
    assert arrive([(7, 6, "later"), (8, 4, "late"), (9, 5, "first"), (200, 1, None)]) == [(7, 6, "later"), (200, 1, None)]
    found = {r["k"]: r["v"] for r in newest.newest(spark, out, spark.createDataFrame([], schema).schema, ["k"], "t").collect()}
    assert found[7] == "later" and found[8] == "first" and len(found) == 101


def test_state_that_expired_changes_nothing(spark):
    schema = spark.createDataFrame([], "k INT, t INT, v STRING").schema
    path, out, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "checkpoint"))
    for rows in ([(1, 5, "new")], [(1, 3, "old")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        newest.append_newest(log.read_stream(spark, path, schema, "*.parquet"), out, checkpoint, ["k"], "t", ttl_ms=1000)
    assert [tuple(r) for r in newest.newest(spark, out, schema, ["k"], "t").collect()] == [(1, 5, "new")]


def test_rank_orders_like_spark(spark):
    values = [None, 1.5, float("nan"), -2.0, float("inf")]
    ordered = [r["x"] for r in spark.createDataFrame([(v,) for v in values], "x DOUBLE").orderBy("x").collect()]
    assert repr(sorted(values, key=lambda v: newest.rank_of([v]))) == repr(ordered)
