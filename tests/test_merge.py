"""Properties of merges, lookups, change feeds and snapshot tables."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from galewright.operators import joins
from galewright.sources import sinks
from galewright.sources.snapshots import SnapshotTable
from galewright.session import fresh_path

SCHEMA = "k INT, a STRING, b INT"


def rows(df):
    return sorted(tuple(r) for r in df.select("k", "a", "b").collect())


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "x", 10), (2, "y", 20), (3, None, 30)], SCHEMA)


@pytest.fixture
def source(spark):
    return spark.createDataFrame([(2, "new", None), (4, "z", 40)], SCHEMA)


def test_merge_updates_and_inserts(target, source):
    merged = joins.merge_upsert(target, source, ["k"])
    assert rows(merged) == [(1, "x", 10), (2, "new", None), (3, None, 30), (4, "z", 40)]
    assert merged.count() == target.count() + joins.anti_unmatched(source, target, ["k"]).count()


def test_merge_twice_is_merge_once(target, source):
    once = joins.merge_upsert(target, source, ["k"])
    assert rows(joins.merge_upsert(once, source, ["k"])) == rows(once)


def test_merge_of_some_columns_keeps_the_others(spark, target):
    patch = spark.createDataFrame([(2, None), (9, 90)], "k INT, b INT")
    merged = joins.merge_upsert(target, patch, ["k"])
    assert rows(merged) == [(1, "x", 10), (2, "y", None), (3, None, 30), (9, None, 90)]


def test_duplicate_source_key_fails(spark, target):
    twice = spark.createDataFrame([(2, "p", 1), (2, "q", 2)], SCHEMA)
    with pytest.raises(PySparkException, match="duplicate key in source"):
        joins.merge_upsert(target, twice, ["k"]).collect()


def test_merge_rejects_unknown_columns(target, source):
    with pytest.raises(ValueError, match="extra"):
        joins.merge_upsert(target, source.withColumn("extra", F.lit(1)), ["k"])


def test_backfill_never_changes_the_row_count(spark, target):
    late = spark.createDataFrame([(1, None), (3, 33), (77, 1)], "k INT, b INT")
    assert rows(joins.backfill(target, late, ["k"], ["b"])) == [(1, "x", 10), (2, "y", 20), (3, None, 33)]


def test_change_feed_replays_to_the_new_version(target, source):
    after = joins.merge_upsert(target, source, ["k"]).filter("k <> 1")
    feed = joins.change_feed(target, after, ["k"])
    kinds = {(r["k"], r["change_type"]) for r in feed.collect()}
    assert kinds == {(1, "delete"), (2, "update_preimage"), (2, "update_postimage"), (4, "insert")}
    gone = feed.filter(F.col("change_type").isin("delete", "update_preimage")).select("k")
    added = feed.filter(F.col("change_type").isin("insert", "update_postimage")).drop("change_type")
    assert rows(target.join(gone, "k", "left_anti").unionByName(added)) == rows(after)


def test_change_feed_refuses_a_null_key(spark, target):
    odd = target.unionByName(spark.createDataFrame([(None, "n", 0)], SCHEMA))
    for before, after in ((odd, target), (target, odd)):
        with pytest.raises(Exception, match="NULL in the key"):
            joins.change_feed(before, after, ["k"]).collect()


@pytest.mark.parametrize("share", [None, 0.1])
def test_repeated_feature_key_fails_the_lookup(spark, share):
    labels = spark.createDataFrame([(1, 0), (2, 1)], "k INT, y INT")
    twice = spark.createDataFrame([(1, 0.5), (1, 0.6), (2, 0.7)], "k INT, f DOUBLE")
    with pytest.raises(PySparkException, match="duplicate key"):
        joins.feature_lookup(labels, twice, "k", ["f"], hot_share=share).collect()


def test_change_feed_of_equal_versions_is_empty(target):
    assert joins.change_feed(target, target, ["k"]).isEmpty()


@pytest.mark.parametrize("share", [None, 0.1, 0.01])
def test_lookup_is_the_same_with_hot_keys_apart(spark, share):
    # One key holds half of the labels, a quarter have no key, and some keys have no features.
    labels = spark.range(4000).select(
        "id", F.expr("CASE WHEN id % 2 = 0 THEN 7 WHEN id % 4 = 1 THEN NULL ELSE id % 100 END").alias("k")
    )
    features = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("f"))
    found = joins.feature_lookup(labels, features, "k", ["f"], hot_share=share)
    wanted = {r["id"]: (r["k"] * 2 if r["k"] is not None and r["k"] < 60 else None) for r in labels.collect()}
    assert {r["id"]: r["f"] for r in found.collect()} == wanted
    assert found.count() == 4000


def test_hot_values_lists_every_heavy_key(spark):
    df = spark.range(9000).select(F.expr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id AS STRING) END").alias("k"))
    found = joins.hot_values(df, "k", 0.1)
    assert "hot" in found and len(found) <= 10


def test_hot_label_rows_are_not_shuffled(spark, plan_of):
    labels = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    features = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("f"))
    plan = plan_of(joins.feature_lookup(labels, features, "k", ["f"], hot_share=0.1))
    apart = plan.split("Union", 1)[1].split("isnull", 1)[0]
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in apart


def test_snapshots(spark, target, source):
    table = SnapshotTable(spark, fresh_path(spark, "t"))
    assert not table.exists()
    assert table.upsert(target, ["k"]) == 0
    assert table.upsert(source, ["k"]) == 1
    assert rows(table.as_of(0)) == rows(target)
    assert rows(table.as_of()) == rows(joins.merge_upsert(target, source, ["k"]))
    assert sorted(tuple(r) for r in table.history().collect()) == [(0, "create", 3), (1, "merge", 4)]
    with pytest.raises(ValueError):
        table.as_of(7)


def test_snapshot_may_replace_what_it_reads(spark, target):
    table = SnapshotTable(spark, fresh_path(spark, "t"))
    table.overwrite(target)
    table.overwrite(table.as_of().filter("k < 3"))
    assert rows(table.as_of()) == [(1, "x", 10), (2, "y", 20)]


def test_uncommitted_version_is_not_visible(spark, target):
    table = SnapshotTable(spark, fresh_path(spark, "t"))
    table.overwrite(target)
    target.write.parquet(f"{table.path}/data/snapshot_version=1")  # a write that never reached the log
    assert table.latest() == 0 and table.all_versions().count() == 3 and table.history().count() == 1
    assert table.overwrite(target.limit(1)) == 1
    assert table.as_of().count() == 1


def test_history_after_a_type_change(spark, target):
    table = SnapshotTable(spark, fresh_path(spark, "t"))
    table.overwrite(target)
    table.overwrite(target.withColumn("b", F.col("b").cast("string")).limit(2))
    assert sorted(tuple(r) for r in table.history().collect()) == [(0, "overwrite", 3), (1, "overwrite", 2)]


def test_malformed_delimited_row_fails(spark, tmp_path):
    from galewright.sources.readers import read_delimited

    (tmp_path / "rows.csv").write_text("k;b\n1;2\noops;3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_delimited(spark, str(tmp_path / "rows.csv"), "k INT, b INT").collect()
    schema = "k INT, b INT, _corrupt_record STRING"
    kept = read_delimited(spark, str(tmp_path / "rows.csv"), schema, mode="PERMISSIVE").collect()
    assert [r["_corrupt_record"] for r in kept] == [None, "oops;3"]
    (tmp_path / "typed.csv").write_text("k;b;t\n1;2.5;x\n2;3;y\n")
    found = read_delimited(spark, str(tmp_path / "typed.csv"))
    assert [t for _, t in found.dtypes] == ["int", "double", "string"] and found.count() == 2


def test_create_fails_on_duplicate_keys(spark):
    twice = spark.createDataFrame([(2, "p", 1), (2, "q", 2)], SCHEMA)
    with pytest.raises(PySparkException, match="duplicate key"):
        SnapshotTable(spark, fresh_path(spark, "t")).upsert(twice, ["k"])


def test_keyed_table_remembers_keys_and_description(spark, target, source):
    table = SnapshotTable(spark, fresh_path(spark, "t"))
    table.create(target, ["k"], "three rows")
    table.upsert(source.drop("a"), ["k"])
    detail = table.detail().first()
    assert (detail["snapshot_version"], detail["primary_keys"], detail["description"]) == (1, ["k"], "three rows")
    assert detail["committed_at"] is not None
    assert rows(table.as_of()) == [(1, "x", 10), (2, "y", None), (3, None, 30), (4, None, 40)]
    with pytest.raises(ValueError, match="keyed by"):
        table.upsert(source, ["a"])
    with pytest.raises(ValueError, match="exists already"):
        table.create(target, ["k"])


def test_training_set_of_two_lookups(spark):
    labels = spark.createDataFrame([(1, 10, 1), (2, 20, 0)], "k INT, j INT, y INT")
    first = spark.createDataFrame([(1, 0.5), (2, 0.7)], "k INT, f DOUBLE")
    second = spark.createDataFrame([(20, "b", 9)], "j INT, g STRING, unused INT")
    found = joins.training_set(labels, [joins.Lookup(first, "k", ["f"]), joins.Lookup(second, "j", ["g"])], ["k", "j"])
    assert sorted(found.columns) == ["f", "g", "y"]
    assert {tuple(r[c] for c in ("y", "f", "g")) for r in found.collect()} == {(1, 0.5, None), (0, 0.7, "b")}


def test_strict_overwrite_keeps_the_schema(spark, target):
    table = SnapshotTable(spark, fresh_path(spark, "t"))
    table.overwrite(target)
    with pytest.raises(sinks.SchemaMismatch, match="stored as int"):
        table.overwrite(target.withColumn("b", F.col("b").cast("string")), keep_schema=True)
    with pytest.raises(sinks.SchemaMismatch, match="missing column a"):
        table.overwrite(target.drop("a"), keep_schema=True)
    assert table.overwrite(target.drop("a")) == 1


def test_append_checks_the_schema(spark, target):
    path = fresh_path(spark, "p")
    target.write.parquet(path)
    sinks.append(target, path)
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(sinks.SchemaMismatch):
        sinks.append(target.drop("a"), path)


def test_reading_a_version_touches_one_folder(spark, target, source):
    table = SnapshotTable(spark, fresh_path(spark, "t"))
    table.overwrite(target)
    table.overwrite(source)
    assert all("snapshot_version=0" in f for f in table.as_of(0).inputFiles())


def test_bucketed_tables_join_without_a_shuffle(spark, plan_of):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        labels = sinks.create_or_replace_table(
            spark.range(1000).select((F.col("id") % 50).alias("k"), "id"), "gw_labels", fresh_path(spark, "b"), ["k"], 4
        )
        features = sinks.create_or_replace_table(
            spark.range(50).select(F.col("id").alias("k"), F.col("id").alias("f")), "gw_features", fresh_path(spark, "b"), ["k"], 4
        )
        joined = joins.feature_lookup(labels, features, "k", ["f"])
        assert "Exchange hashpartitioning" not in plan_of(joined)
        assert joined.filter("k = f").count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
