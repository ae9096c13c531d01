"""Row numbers, stable keys, samples and splits."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from galewright.functions.hashing import digest, lowest_share, weighted_choice
from galewright.operators import keys, sampling


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of all rows share one value; many share their order columns."""
    return spark.range(5000).select(
        "id", F.expr("CASE WHEN id % 2 = 0 THEN 'hot' ELSE concat('g', id % 40) END").alias("g"), (F.col("id") % 7).alias("v")
    )


@pytest.mark.parametrize("partitions", [None, 1, 5, 16])
def test_global_row_number_equals_the_window(spark, skewed, partitions):
    numbered = keys.global_row_number(skewed, ["g", "v", "id"], "n", partitions)
    naive = skewed.select("id", F.row_number().over(Window.orderBy("g", "v", "id")).alias("m"))
    assert numbered.join(naive, "id").filter("n <> m").isEmpty()
    assert numbered.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()[:] == (1, 5000, 5000)


def test_global_row_number_moves_no_rows_through_one_task(spark, skewed, plan_of):
    plan = plan_of(keys.global_row_number(skewed, ["g", "v", "id"], "n", 8))
    # The only single-partition step sums the partition sizes, after they were aggregated.
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate" in part[:400]


@pytest.mark.parametrize("partitions", [None, 1, 7, 40])
@pytest.mark.parametrize("hot", [0.9, 0.0])
def test_rank_by_digest_equals_the_window(spark, partitions, hot):
    """One group with 90 % of the rows, or many medium groups, one of them NULL."""
    group = F.when(F.col("id") < 5000 * hot, F.lit("hot")).otherwise(F.nullif(F.concat(F.lit("g"), F.col("id") % 40), F.lit("g3")))
    skewed = spark.range(5000).select("id", group.alias("g"))
    ranked = keys.row_number_by_digest(skewed, "g", "id", "n", partitions=partitions)
    order = Window.partitionBy("g").orderBy(F.md5(F.concat_ws("|", F.col("id").cast("string"), F.lit("rank"))), "id")
    naive = skewed.select("id", F.row_number().over(order).alias("m"))
    assert ranked.join(naive, "id").filter("n <> m").isEmpty() and ranked.count() == 5000


def test_a_hot_group_is_cut_between_partitions(spark):
    hot = spark.range(5000).select("id", F.lit("hot").alias("g"))
    ranked = keys.row_number_by_digest(hot, "g", "id", "n", partitions=16)
    assert ranked.select(F.spark_partition_id()).distinct().count() > 1
    assert ranked.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()[:] == (1, 5000, 5000)


def test_stable_key_is_unique_and_stable(spark, skewed):
    one = keys.stable_key(skewed, ["g", "v"], "id")
    two = keys.stable_key(skewed.repartition(13), ["g", "v"], "id")
    assert one.select("stable_key").distinct().count() == 5000
    assert one.join(two, ["id", "stable_key"]).count() == 5000


def test_stable_key_survives_an_append(spark, plan_of):
    old = spark.range(40).select("id", F.lit("same").alias("g"))
    new = old.unionByName(spark.range(40, 45).select("id", F.lit("same").alias("g")))
    before, after = (keys.stable_key(df, ["g"], "id") for df in (old, new))
    assert before.join(after, ["id", "stable_key"]).count() == 40
    assert "Exchange" not in plan_of(after)


def test_row_hash_tells_null_from_empty(spark):
    df = spark.createDataFrame([(None,), ("",)], "a STRING")
    assert df.select(keys.row_hash(["a"])).distinct().count() == 2


def test_sample_does_not_depend_on_partitioning(spark):
    df = spark.range(20000)
    one = {r[0] for r in sampling.hash_sample(df.repartition(1), "id", 0.2).collect()}
    many = {r[0] for r in sampling.hash_sample(df.repartition(9), "id", 0.2).collect()}
    assert one == many and 0.18 < len(one) / 20000 < 0.22


def check_split(df, split):
    total = {r["g"]: r["count"] for r in df.groupBy("g").count().collect()}
    test = {r["g"]: r["count"] for r in split.filter("split = 'test'").groupBy("g").count().collect()}
    assert test == {g: -(-n * 20 // 100) for g, n in total.items()}
    assert split.count() == df.count() == split.select("id").distinct().count()


def test_split_is_exact_per_class(spark, skewed):
    check_split(skewed, sampling.stratified_split(skewed, "id", "g"))


def test_split_of_many_classes(spark):
    df = spark.range(6000).select("id", (F.col("id") % 1500).alias("g"))
    check_split(df, sampling.stratified_split(df, "id", "g"))


def test_split_handles_null_classes_and_empty_input(spark):
    df = spark.range(100).select("id", F.nullif(F.col("id") % 2, F.lit(0)).alias("g"))
    split = sampling.stratified_split(df, "id", "g")
    assert split.filter("split = 'test' AND g IS NULL").count() == 10
    assert sampling.stratified_split(df.limit(0), "id", "g").count() == 0


def test_no_split_shuffles_rows_by_class(spark, skewed, plan_of):
    for split in (sampling.stratified_split(skewed, "id", "v"), sampling.nested_split(skewed, "id", "v")):
        plan = plan_of(split)
        assert "BroadcastHashJoin" in plan and "hashpartitioning(_class" not in plan


def test_nested_split_is_disjoint_and_complete(spark, skewed):
    split = sampling.nested_split(skewed, "id", "v", 20, 33)
    assert split.count() == split.select("id").distinct().count() == 5000
    outer = sampling.stratified_split(skewed, "id", "v", 20)
    same = outer.filter("split = 'test'").join(split.filter("split = 'test'").select("id"), "id").count()
    assert same == outer.filter("split = 'test'").count() == split.filter("split = 'test'").count()
    for v, n, held in split.filter("split <> 'test'").groupBy("v").agg(
        F.count("*"), F.count_if(F.col("split") == "validation")
    ).collect():
        assert held == -(-n * 33 // 100)


def test_weighted_choice_follows_the_weights(spark):
    df = spark.range(20000).select(weighted_choice("id", ("a", "b", "c"), (5, 0, 5), "s").alias("v"))
    counts = {r["v"]: r["count"] for r in df.groupBy("v").count().collect()}
    assert set(counts) == {"a", "c"} and 0.47 < counts["a"] / 20000 < 0.53
    with pytest.raises(ValueError):
        weighted_choice("id", ("a",), (0,), "s")


@pytest.mark.parametrize("share", [0.0, 0.001, 0.5, 1.0])
def test_lowest_share(spark, share):
    found = spark.range(20000).filter(lowest_share(digest("id", salt=1), share)).count() / 20000
    assert found == share if share in (0.0, 1.0) else abs(found - share) < 0.02
