"""Reproducible samples and stratified splits. Nothing here depends on partitioning or on ``rand``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galewright.functions.hashing import digest, lowest_share
from galewright.session import materialize


def hash_sample(df: DataFrame, key: str, share: float, salt: str | int = 42) -> DataFrame:
    """A Bernoulli-like sample decided by the key's digest: one narrow filter."""
    return df.filter(lowest_share(digest(key, salt=salt), share))


def hash_split(df: DataFrame, key: str, test_share: float, salt: str | int = 42, name: str = "split") -> DataFrame:
    """Approximate split by digest: one narrow projection. Class shares hold in expectation."""
    in_test = lowest_share(digest(key, salt=salt), test_share)
    return df.withColumn(name, F.when(in_test, F.lit("test")).otherwise(F.lit("train")))


def stratified_split(
    df: DataFrame,
    key: str,
    label: str,
    test_percent: int = 20,
    salt: str | int = 42,
    name: str = "split",
    parts: Sequence[str] = ("train", "test"),
) -> DataFrame:
    """Exact split: per class, the ``ceil(percent · n)`` rows with the smallest digests are test.

    Ranking a class would send a whole class to one task. Instead class and digest are written once, and a
    histogram over the first four hex digits finds the prefix that holds each class's last test row; only that
    prefix, one row in 65,536, is ranked. The cuts, one row per class, are written before they
    join the rows: so Spark knows their size when it plans and broadcasts them, unless classes are very many. A
    join of unknown size is planned as a shuffle by class, which brings a whole class to one task. ``key`` must be unique.
    """
    drawn = digest(key, salt=salt)
    digests = materialize(df.select(_class_text(label).alias("_class"), drawn.alias("_d")), "digests")
    known = df.withColumn("_class", _class_text(label)).join(_cuts(digests, test_percent), "_class", "left")
    return known.select(*df.columns, F.when(_below(drawn, "_cut"), F.lit(parts[1])).otherwise(F.lit(parts[0])).alias(name))


def nested_split(
    df: DataFrame,
    key: str,
    label: str,
    test_percent: int = 20,
    validation_percent: int = 33,
    salt: str | int = 42,
    name: str = "split",
) -> DataFrame:
    """train / validation / test: a second stratified split, with its own salt, inside the training part."""
    outer, inner = digest(key, salt=salt), digest(key, salt=f"{salt}-inner")
    digests = materialize(df.select(_class_text(label).alias("_class"), outer.alias("_d"), inner.alias("_e")), "digests")
    tests = _cuts(digests.select("_class", "_d"), test_percent)
    rest = digests.join(tests, "_class", "left").filter(~_below(F.col("_d"), "_cut")).select("_class", F.col("_e").alias("_d"))
    both = tests.join(_cuts(rest, validation_percent).withColumnRenamed("_cut", "_inner_cut"), "_class", "left")
    known = df.withColumn("_class", _class_text(label)).join(materialize(both, "cuts"), "_class", "left")
    part = F.when(_below(outer, "_cut"), F.lit("test")).when(_below(inner, "_inner_cut"), F.lit("validation"))
    return known.select(*df.columns, part.otherwise(F.lit("train")).alias(name))


def _cuts(digests: DataFrame, percent: int) -> DataFrame:
    """``(_class, _cut)``: the digest of each class's last row among its first ``percent``."""
    known = digests.withColumn("_prefix", F.substring("_d", 1, 4))
    counts = materialize(known.groupBy("_class", "_prefix").agg(F.count(F.lit(1)).alias("_n")), "cuts")
    whole = Window.partitionBy("_class").orderBy("_prefix")
    running = counts.select(
        "*",
        F.sum("_n").over(whole.rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"),
        F.sum("_n").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_total"),
    )
    before, want = F.col("_upto") - F.col("_n"), F.expr(f"(_total * {int(percent)} + 99) div 100")
    edge = running.filter((F.col("_upto") >= want) & (before < want)).select("_class", "_prefix", (want - before).alias("_want"))
    rank = F.row_number().over(Window.partitionBy("_class").orderBy("_d"))
    ranked = known.join(materialize(edge, "cuts"), ["_class", "_prefix"]).withColumn("_rank", rank)
    return materialize(ranked.filter(F.col("_rank") == F.col("_want")).select("_class", F.col("_d").alias("_cut")), "cuts")


def _below(digest_col: Column, cut: str) -> Column:
    return F.coalesce(digest_col <= F.col(cut), F.lit(False))


def _class_text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("\\N"))
