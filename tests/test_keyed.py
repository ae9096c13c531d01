"""Merges into buckets: what is rewritten, what is kept as changes, and what a repeated merge does."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from galewright.operators import joins
from galewright.session import fresh_path
from galewright.sources import sinks
from galewright.sources.keyed import BucketedTable

SCHEMA = "k LONG, a STRING, b INT"


@pytest.fixture
def table(spark):
    held = BucketedTable(spark, fresh_path(spark, "keyed"), ["k"], buckets=20)
    held.create(spark.range(2000).select(F.col("id").alias("k"), F.concat(F.lit("a"), "id").alias("a"), F.lit(0).alias("b")))
    return held


def rows(df):
    return sorted((tuple(r) for r in df.select("k", "a", "b").collect()), key=repr)


def files(table):
    return set(table.rows().inputFiles())


def keys_of_buckets(table, wanted):
    found = table.spark.read.parquet(f"{table.path}/rows").filter(F.col("_bucket").isin(wanted))
    return [r["k"] for r in found.select("k").collect()]


def test_a_small_merge_rewrites_only_the_touched_buckets(spark, table):
    before, old = files(table), rows(table.rows())
    some = keys_of_buckets(table, [3, 11])[:20]  # one per cent of the keys, in two of twenty buckets
    source = spark.createDataFrame([(k, "new", 1) for k in some], SCHEMA)
    assert table.merge(source, "one") and len(some) == 20
    gone, come = before - files(table), files(table) - before
    touched = {f.split("_bucket=")[1].split("/")[0] for f in gone | come}
    assert touched <= {"3", "11"} and len(before & files(table)) == len(before) - len(gone) >= 18
    assert rows(table.rows()) == sorted([*(r for r in old if r[0] not in some), *((k, "new", 1) for k in some)], key=repr)


def test_changes_are_what_the_merge_wrote(spark, table):
    before = spark.createDataFrame(table.rows().collect(), SCHEMA)
    source = spark.createDataFrame([(5, "x", 1), (6, "a6", 0), (-1, None, 7)], SCHEMA)
    table.merge(source, "one")
    kept = {(r["k"], r["a"], r["b"], r["change_type"]) for r in table.changes("one").collect()}
    assert kept == {(5, "a5", 0, "update_preimage"), (5, "x", 1, "update_postimage"), (-1, None, 7, "insert")}  # 6 was the same
    compared = joins.change_feed(before, table.rows(), ["k"])
    assert {(r["k"], r["a"], r["b"], r["change_type"]) for r in compared.collect()} == kept


def test_changes_are_read_without_a_join(table, spark, plan_of):
    table.merge(spark.createDataFrame([(5, "x", 1)], SCHEMA), "one")
    assert "Join" not in plan_of(table.changes("one"))


def test_merge_equals_the_plain_merge(spark, table):
    before = spark.createDataFrame(table.rows().collect(), SCHEMA)
    rows_whole = spark.range(1990, 2100).select(F.col("id").alias("k"), F.lit("z").alias("a"), F.lit(None).cast("int").alias("b"))
    one_column = spark.range(0, 50).select(F.col("id").alias("k"), F.lit(4).alias("b"))
    for number, source in enumerate((rows_whole, one_column)):
        before = joins.merge_upsert(before, source, ["k"])
        table.merge(source, f"m{number}")
    assert rows(table.rows()) == rows(before)


def test_a_merge_given_again_changes_nothing(spark, table):
    source = spark.createDataFrame([(5, "x", 1), (-1, "n", 2)], SCHEMA)
    table.merge(source, "one")
    after, changes = rows(table.rows()), table.changes("one").count()
    table.merge(source.withColumn("b", F.lit(9)), "one")  # the name decides, as after a failure
    assert rows(table.rows()) == after and table.changes("one").count() == changes


def test_a_merge_that_failed_between_its_writes_is_completed(spark, table):
    source = spark.createDataFrame([(5, "x", 1)], SCHEMA)
    passed = table._passed(table._incoming(source))
    passed.write.partitionBy("change_type").parquet(f"{table.path}/changes/commit=one")  # and no bucket yet
    table.merge(source, "one")
    assert (5, "x", 1) in rows(table.rows()) and table.rows().count() == 2000


def test_an_empty_source_writes_no_bucket(spark, table):
    before = files(table)
    assert table.merge(spark.createDataFrame([], SCHEMA), "none") == []
    assert files(table) == before and table.changes("none").count() == 0


def test_bad_sources_fail(spark, table):
    for bad, message in (([(1, "p", 1), (1, "q", 2)], "duplicate key"), ([(None, "p", 1)], "NULL in the key")):
        with pytest.raises(Exception, match=message):
            table.merge(spark.createDataFrame(bad, SCHEMA), message.split()[0])
    with pytest.raises(ValueError, match="extra"):
        table.merge(spark.createDataFrame([(1, 2)], "k LONG, extra INT"), "x")
    with pytest.raises(sinks.SchemaMismatch):
        table.merge(spark.createDataFrame([(1, 2)], "k INT, b INT"), "x")


def test_the_source_is_computed_once(spark, table):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    source = spark.createDataFrame([(5, "x", 1), (6, "y", 1)], SCHEMA).mapInPandas(count, SCHEMA)
    table.merge(source, "one")
    assert seen.value == 2
    joins.merge_upsert(table.rows(), source, ["k"]).collect()
    assert seen.value == 4
