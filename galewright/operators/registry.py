"""Runs, versions, aliases and the promotion gate as pure DataFrame functions.

A run table has one row per run and metric: ``(model_name, run_id, run_name, status, metric, value)``.
Aliases are ``(model_name, alias, version)``, versions ``(model_name, version, run_id)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galewright.operators.metrics import metric_rows

# The metric names a run may carry its F1 under, in order of preference after the wanted one.
F1_NAMES = (
    "f1_weighted",
    "f1_score_weighted",
    "f1_score_wighted",
    "test_f1_score",
    "val_f1",
    "f1_binary",
)
# Gate thresholds and alias names.
MINIMUM_F1 = 0.72
PROMOTION_THRESHOLD = 0.01
CHAMPION, CHALLENGER, LATEST = "champion", "challenger", "latest-model"


def run_metric_rows(wide: DataFrame, run_cols: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Rows for the run table from one wide row of metrics per run."""
    return metric_rows(wide, run_cols, metrics).filter(F.col("value").isNotNull())


def coalesce_metrics(
    runs: DataFrame, run_cols: Sequence[str], preferred: str, fallback: Sequence[str] = F1_NAMES, strict: bool = True
) -> DataFrame:
    """One value per run: the first metric present in order of preference.

    ``strict`` makes a run without any of them fail the job instead of passing on NULL.
    """
    names = [preferred, *[m for m in fallback if m != preferred]]
    found = runs.groupBy(*run_cols).agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(f"_{i}") for i, m in enumerate(names)]
    )
    candidates: list[Column] = [F.col(f"_{i}") for i in range(len(names))]
    if strict:
        message = F.concat(F.lit("no F1 metric in run "), F.to_json(F.struct(*run_cols)))
        candidates.append(F.raise_error(message).cast("double"))
    return found.select(*run_cols, F.coalesce(*candidates).alias("value"))


def leaderboard(runs: DataFrame, metric: str, k: int = 10, optional: Sequence[str] = ()) -> DataFrame:
    """The best ``k`` finished runs by one metric, with those of the other metrics that exist as columns."""
    shown = [metric, *[m for m in optional if m != metric]]
    wide = (
        runs.filter(F.col("status") == "FINISHED")
        .groupBy("model_name", "run_id", "run_name")
        .agg(*[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in shown])
    )
    return wide.orderBy(F.col(metric).desc_nulls_last(), F.col("run_id")).limit(k)


def best_per_group(df: DataFrame, group: Sequence[str], value: str, tie: Sequence[str], n: int = 2) -> DataFrame:
    """The ``n`` best rows per group with their rank.

    The filter on the row number lets Spark keep only ``n`` rows per group before the shuffle too.
    """
    order = Window.partitionBy(*group).orderBy(F.col(value).desc_nulls_last(), *tie)
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def aliases_from_ranks(ranked: DataFrame) -> DataFrame:
    """Best version → champion, second → challenger."""
    alias = F.when(F.col("rank") == 1, F.lit(CHAMPION)).otherwise(F.lit(CHALLENGER))
    return ranked.select("model_name", alias.alias("alias"), "version")


def resolve_alias(
    aliases: DataFrame, versions: DataFrame, run_values: DataFrame, priority: Sequence[str] = (CHALLENGER, LATEST)
) -> DataFrame:
    """Per model: the version behind the first alias that exists, its run and the run's metric value."""
    rank = F.array_position(F.array(*[F.lit(a) for a in priority]), F.col("alias"))
    known = aliases.filter(F.col("alias").isin(*priority)).withColumn("_rank", rank)
    chosen = known.groupBy("model_name").agg(F.min_by(F.struct("alias", "version"), "_rank").alias("_a"))
    flat = chosen.select("model_name", "_a.alias", "_a.version")
    return (
        flat.join(versions, ["model_name", "version"])
        .join(run_values.select("model_name", "run_id", "value"), ["model_name", "run_id"], "left")
        .select("model_name", "alias", "version", "run_id", "value")
    )


def quality_gate(
    candidates: DataFrame,
    candidate: str = "candidate_f1",
    champion: str = "champion_f1",
    minimum: float = MINIMUM_F1,
    threshold: float = PROMOTION_THRESHOLD,
) -> DataFrame:
    """Add ``minimum_quality_passed``, ``required_f1``, ``beats_champion`` and ``evaluation_passed`` (0/1).

    Without a champion the second test passes. There is none where ``champion_version`` is NULL, or,
    in a table without that column, where the champion's metric is. A missing candidate metric passes
    neither test. A champion version without its metric fails the job: nothing can be said about it.
    """
    versioned = "champion_version" in candidates.columns
    known = F.col(champion)
    if versioned:
        lost = F.concat(F.lit("no metric for champion version "), F.col("champion_version").cast("string"))
        known = F.when(F.col("champion_version").isNotNull() & known.isNull(), F.raise_error(lost).cast("double")).otherwise(known)
    required = known * F.lit(1 + threshold)
    good = F.col(candidate) >= F.lit(minimum)
    none = F.col("champion_version").isNull() if versioned else F.col(champion).isNull()
    better = F.when(none, F.col(candidate).isNotNull()).otherwise(F.col(candidate) > required)

    def as_flag(c: Column) -> Column:
        return F.coalesce(c, F.lit(False)).cast("int")

    return candidates.withColumns(
        {
            "required_f1": required,
            "minimum_quality_passed": as_flag(good),
            "beats_champion": as_flag(better),
            "evaluation_passed": as_flag(good & better),
        }
    )


def champion_and_challenger(aliases: DataFrame, versions: DataFrame, run_values: DataFrame) -> DataFrame:
    """One row per challenger with the champion of its model, if there is one."""
    challengers = resolve_alias(aliases, versions, run_values, (CHALLENGER, LATEST)).select(
        "model_name", F.col("version").alias("challenger_version"), F.col("value").alias("candidate_f1")
    )
    champions = resolve_alias(aliases, versions, run_values, (CHAMPION,)).select(
        "model_name", F.col("version").alias("champion_version"), F.col("value").alias("champion_f1")
    )
    return challengers.join(champions, "model_name", "left")


def promote_decision(pairs: DataFrame, threshold: float = PROMOTION_THRESHOLD) -> DataFrame:
    """Per model: promoted flag, old and new champion version, both metrics and the phases to tag."""
    judged = quality_gate(pairs, minimum=float("-inf"), threshold=threshold)
    promoted = F.col("beats_champion") == 1
    return judged.select(
        "model_name",
        F.col("beats_champion").alias("promoted"),
        F.col("champion_version").alias("old_champion_version"),
        F.when(promoted, F.col("challenger_version")).otherwise(F.col("champion_version")).alias("new_champion_version"),
        F.col("champion_f1").alias("champion_metric"),
        F.col("candidate_f1").alias("challenger_metric"),
        F.when(promoted, F.lit("champion")).otherwise(F.lit("challenger")).alias("challenger_phase"),
        F.when(promoted & F.col("champion_version").isNotNull(), F.lit("previous_champion"))
        .when(F.col("champion_version").isNotNull(), F.lit("champion"))
        .alias("champion_phase"),
    )


def next_aliases(aliases: DataFrame, decisions: DataFrame) -> DataFrame:
    """The alias table after the decisions: the champion alias moves, all other aliases stay."""
    moved = decisions.filter(F.col("new_champion_version").isNotNull()).select(
        "model_name", F.lit(CHAMPION).alias("alias"), F.col("new_champion_version").alias("version")
    )
    kept = aliases.join(moved.select("model_name", "alias"), ["model_name", "alias"], "left_anti")
    return kept.unionByName(moved)


def segment_gate(
    quality: DataFrame,
    segment: str,
    version: str,
    champion: str | int,
    challenger: str | int,
    value: str = "weighted_f1",
    minimum: float = MINIMUM_F1,
    threshold: float = PROMOTION_THRESHOLD,
) -> DataFrame:
    """The gate per segment, from per-segment metrics of two model versions.

    ``quality`` has one row per segment and version, so a conditional aggregation pairs them
    without a self-join.
    """
    pairs = quality.groupBy(segment).agg(
        F.max(F.when(F.col(version) == champion, F.col(value))).alias("champion_f1"),
        F.max(F.when(F.col(version) == challenger, F.col(value))).alias("candidate_f1"),
    )
    return quality_gate(pairs, minimum=minimum, threshold=threshold)


# Poisson(1) probabilities of at most 0, 1, 2, … as shares of 2³², rounded.
_POISSON = (1580030169, 3160060337, 3950075422, 4213413783, 4279248374, 4292415292, 4294609778, 4294923276)


def poisson_weight(key: str, replica: Column) -> Column:
    """How often a row counts in a bootstrap replica: Poisson(1) drawn from the md5 of key and replica.

    Eight hex digits sort like the number they stand for, so they are compared as text, up to the first edge above.
    """
    share = F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit("|"), replica.cast("string"))), 1, 8)
    edges = [f"{v:08x}" for v in _POISSON]
    weight = F.when(share < edges[0], 0)
    for n, edge in enumerate(edges[1:], 1):
        weight = weight.when(share < edge, n)
    return F.when(share.isNotNull(), weight.otherwise(len(edges))).otherwise(0)


def segment_gain_bounds(
    rows: DataFrame, key: str, segment: str, version: str, champion: str | int, challenger: str | int,
    label: str, prediction: str, replicas: int = 40, low_rank: int = 2,
) -> DataFrame:
    """``(segment, champion_f1, candidate_f1, gain, gain_low)``: the F1 gain and its lower bound per segment.

    A Poisson bootstrap in one pass: each row counts 0, 1, 2, … times in every replica, as its key's digest says,
    and only one sum per segment, version, replica and outcome is shuffled. The digests are the work, so the rows are
    first dealt evenly to a fixed number of tasks: by their bytes Spark would give them to a few.
    ``gain_low`` is the ``low_rank``-th smallest gain of the replicas (2 of 40: the lower end of a 95 % interval).
    Replica 0 is the rows as they are. A segment that lacks one of the versions has NULL for it and for the gain.
    """
    y, p = F.col(label) == 1, F.col(prediction) == 1
    wanted = rows.filter(F.col(version).isin(champion, challenger) & F.col(label).isNotNull() & F.col(prediction).isNotNull())
    narrow = wanted.select(F.col(key).cast("string").alias("_key"), segment, version, y.alias("_y"), p.alias("_p"))
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    each = narrow.repartition(tasks, "_key").withColumn("_replica", F.explode(F.sequence(F.lit(0), F.lit(replicas))))
    each = each.withColumn("_n", F.when(F.col("_replica") == 0, F.lit(1)).otherwise(poisson_weight("_key", F.col("_replica"))))
    cells = each.groupBy(segment, "_replica", version, "_y", "_p").agg(F.sum("_n").alias("_n"))

    def f1(side: str | int) -> Column:
        n = F.when(F.col(version) == side, F.col("_n")).otherwise(0)
        hit, given, meant = (F.sum(F.when(c, n).otherwise(0)) for c in (F.col("_y") & F.col("_p"), F.col("_p"), F.col("_y")))
        met = F.sum(F.when(F.col(version) == side, 1).otherwise(0)) > 0
        return F.when(met, F.coalesce(F.try_divide((2 * hit).cast("double"), (given + meant).cast("double")), F.lit(0.0)))

    found = cells.groupBy(segment, "_replica").agg(f1(champion).alias("champion_f1"), f1(challenger).alias("candidate_f1"))
    gain = F.col("candidate_f1") - F.col("champion_f1")
    whole = F.col("_replica") == 0
    drawn = F.sort_array(F.collect_list(F.when(~whole, gain)))  # one number a replica
    return found.groupBy(segment).agg(
        F.max(F.when(whole, F.col("champion_f1"))).alias("champion_f1"),
        F.max(F.when(whole, F.col("candidate_f1"))).alias("candidate_f1"),
        F.max(F.when(whole, gain)).alias("gain"),
        F.get(drawn, F.lit(low_rank - 1)).alias("gain_low"),
    )
