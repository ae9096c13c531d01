"""What the plans read, prune and shuffle."""

from __future__ import annotations

import re

import pytest

from pyspark.sql import functions as F

from galewright import session
from galewright.operators import joins, sampling
from galewright.plans import registered
from galewright.sources import sinks
from galewright.sources.fixtures import contacts, table


def test_scans_read_only_needed_columns(spark, tiny, plan_of):
    plan = plan_of(registered()["class_balance"].build(spark, tiny))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    read = sorted(sorted(c.split(":")[0] for c in s.split(",")) for s in schemas)
    assert read == [["c_acctbal", "c_custkey"], ["o_custkey", "o_orderstatus", "o_totalprice"]]


def test_filters_reach_the_scan(spark, tiny, plan_of):
    rows = contacts(spark, tiny).filter(F.col("job") == "BUILDING")
    assert "EqualTo(c_mktsegment,BUILDING)" in plan_of(rows)


def test_a_split_reads_one_partition(spark, tiny, plan_of):
    path = session.fresh_path(spark, "split")
    rows = table(spark, tiny, "orders").select("o_orderkey", "o_orderstatus")
    sinks.write_splits(sampling.hash_split(rows, "o_orderkey", 0.2), path)
    assert "PartitionFilters: [isnotnull(split" in plan_of(sinks.read_split(spark, path, "test"))


def test_small_source_does_not_shuffle_the_target(spark, tiny, plan_of):
    orders = table(spark, tiny, "orders")
    corrected = orders.filter("o_orderpriority = '1-URGENT'").withColumn("o_totalprice", F.lit(1.0))
    plan = plan_of(joins.merge_upsert(orders, corrected, ["o_orderkey"]))
    assert "LeftAnti" in plan and "SortMergeJoin" not in plan
    main = plan.split("Subquery")[0]
    assert "Exchange hashpartitioning" not in main


def test_skewed_foreign_key_is_split_at_run_time(spark, tiny, tmp_path):
    """Half of the orders belong to one customer; the join of the contact adapter splits that partition."""
    source = tmp_path / "skewed"
    orders = spark.range(200_000).select(
        F.col("id").alias("o_orderkey"), F.expr("CASE WHEN id % 2 = 0 THEN 1 ELSE id % 150 END").alias("o_custkey"),
        F.lit("F").alias("o_orderstatus"), (F.col("id") * 1.5).alias("o_totalprice"),
    )
    orders.repartition(8).write.parquet(str(source / "orders.parquet"))
    table(spark, tiny, "customer").write.parquet(str(source / "customer.parquet"))
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        rows = contacts(spark, str(source)).groupBy("job").agg(F.count("*").alias("n"), F.sum("duration"), F.max("contact_key"))
        assert sum(r["n"] for r in rows.collect()) == spark.range(200_000).filter("id % 2 = 0 OR id % 150 > 0").count()
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hash_sample_is_one_narrow_filter(spark, tiny, plan_of):
    plan = plan_of(sampling.hash_sample(table(spark, tiny, "events"), "event_id", 0.2))
    assert "Exchange" not in plan and "Python" not in plan


def test_no_query_uses_row_at_a_time_python(spark, tiny, plan_of):
    for name in ("preset_v2_ratio", "score_linear", "profile_sliced", "roc_auc", "one_hot", "standard_scale", "weighted_choice"):
        plan = plan_of(registered()[name].build(spark, tiny))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_no_shared_folder_on_a_cluster_raises():

    assert session.is_local("local[8]") and session.is_local("local") and not session.is_local("local-cluster[2,1,1024]")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session._own_dir(master)
    assert session._own_dir("local[2]") == session._own_dir("local")


def test_shared_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert session.shared_dir(spark) == named.rstrip("/")
    assert session.fresh_path(spark, "x").startswith(session.shared_dir(spark))


def test_materialized_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_WRITTEN", [])
    monkeypatch.setattr(session, "shared_dir", lambda s: str(tmp_path))
    kept = session.materialize(spark.range(5), "gone")
    assert kept.count() == 5
    assert session.drop_materialized(spark) == 1 and not any(tmp_path.iterdir())
