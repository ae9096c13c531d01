"""Runs, versions, aliases and gates derived from the scored log.

Thirty runs of five models: the user number modulo 30 names the run that served the user.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galewright.functions.numeric import half_up
from galewright.operators import metrics, registry, scoring
from galewright.plans.quality import ACCURACY, F1, LABEL, PRECISION, PREDICTION, RECALL, WEIGHTED_F1, counts_sql, rounded
from galewright.plans.registration import CONTACTS, query, with_sql
from galewright.session import fresh_path, materialize
from galewright.sources.fixtures import contacts, table
from galewright.sources.snapshots import SnapshotTable

_RUN = {
    "model_name": "concat('model-', CAST(user_id % 5 AS STRING))",
    "run_id": "concat('run-', CAST(user_id % 30 AS STRING))",
    "version": "CAST(1 + FLOOR((user_id % 30) / 5) AS INT)",
    "status": "CASE WHEN (user_id % 30) % 7 = 3 THEN 'FAILED' ELSE 'FINISHED' END",
    "y_flag": "CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END",
    "prediction": "CASE WHEN value >= 40 THEN 1 ELSE 0 END",
}
_BY = ["model_name", "run_id", "version", "status"]
_SERVED = f"served AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _RUN.items())} FROM events)"
_COUNTS = counts_sql("served", ", ".join(_BY))
# Newer versions log their weighted F1 under other names than older ones.
_F1_NAME = "CASE WHEN version <= 2 THEN 'f1_weighted' WHEN version <= 4 THEN 'f1_score_weighted' ELSE 'f1_score_wighted' END"
_METRICS = {"'accuracy'": ACCURACY, "'precision'": PRECISION, "'recall'": RECALL, "'f1_binary'": F1, _F1_NAME: WEIGHTED_F1}
_RUNS = "runs AS (" + " UNION ALL ".join(
    f"SELECT model_name, run_id, concat('trial of ', run_id) AS run_name, version, status, {n} AS metric, {e} AS value FROM c" for n, e in _METRICS.items()
) + ")"
_F1S = "f1s AS (SELECT model_name, run_id, version, status, value FROM runs WHERE metric IN ('f1_weighted', 'f1_score_weighted', 'f1_score_wighted'))"
# Champion: best accuracy. Challenger: second best, except for one model without one. Latest: highest version.
_ALIASES = """ranked AS (SELECT model_name, version, row_number() OVER (PARTITION BY model_name ORDER BY value DESC, run_id) AS r FROM runs WHERE metric = 'accuracy'),
aliases AS (SELECT model_name, CASE WHEN r = 1 THEN 'champion' ELSE 'challenger' END AS alias, version FROM ranked WHERE r <= 2 AND NOT (r = 2 AND model_name = 'model-4')
  UNION ALL SELECT model_name, 'latest-model', max(version) FROM runs GROUP BY model_name)"""
_PAIRS = """pairs AS (SELECT ch.model_name, ch.version AS challenger_version, cf.value AS candidate_f1, cm.version AS champion_version, mf.value AS champion_f1
  FROM (SELECT model_name, version, row_number() OVER (PARTITION BY model_name ORDER BY CASE alias WHEN 'challenger' THEN 1 ELSE 2 END) AS o FROM aliases WHERE alias <> 'champion') ch
  JOIN f1s cf ON cf.model_name = ch.model_name AND cf.version = ch.version
  LEFT JOIN (SELECT * FROM aliases WHERE alias = 'champion' AND model_name <> 'model-3') cm ON cm.model_name = ch.model_name
  LEFT JOIN f1s mf ON mf.model_name = cm.model_name AND mf.version = cm.version WHERE ch.o = 1)"""


def _sql(*more: str) -> str:
    return with_sql(_SERVED, _COUNTS, _RUNS, _F1S, *more)


def run_table(spark: SparkSession, sf: str) -> DataFrame:
    """(model_name, run_id, run_name, version, status, metric, value), from one pass over the log.

    Stored, as a run table is: what follows reads the few run rows, not the log again.
    """
    served = table(spark, sf, "events").select(*[F.expr(e).alias(n) for n, e in _RUN.items()])
    wide = metrics.all_metrics(served, LABEL, PREDICTION, _BY).withColumnRenamed("f1", "f1_binary")
    rows = registry.run_metric_rows(wide, _BY, ["accuracy", "precision", "recall", "f1_binary", "weighted_f1"])
    name = F.when(F.col("metric") == "weighted_f1", F.expr(_F1_NAME)).otherwise(F.col("metric"))
    named = rows.withColumns({"metric": name, "run_name": F.concat(F.lit("trial of "), F.col("run_id"))})
    return materialize(named.select("model_name", "run_id", "run_name", "version", "status", "metric", "value"), "runs")


def run_f1(runs: DataFrame) -> DataFrame:
    return registry.coalesce_metrics(runs, ["model_name", "run_id", "version", "status"], "f1_weighted")


def alias_table(runs: DataFrame) -> DataFrame:
    accuracy = runs.filter(F.col("metric") == "accuracy").select("model_name", "version", "run_id", "value")
    ranked = registry.best_per_group(accuracy, ["model_name"], "value", ["run_id"])
    best = registry.aliases_from_ranks(ranked)
    known = best.filter(~((F.col("alias") == registry.CHALLENGER) & (F.col("model_name") == "model-4")))
    latest = runs.groupBy("model_name").agg(F.max("version").alias("version")).withColumn("alias", F.lit(registry.LATEST))
    return known.unionByName(latest)


def pairs(runs: DataFrame) -> DataFrame:
    """Challenger and champion per model; one model has no champion yet."""
    no_champion = (F.col("alias") == registry.CHAMPION) & (F.col("model_name") == "model-3")
    return registry.champion_and_challenger(alias_table(runs).filter(~no_champion), versions(runs), run_f1(runs))


def versions(runs: DataFrame) -> DataFrame:
    return runs.select("model_name", "version", "run_id").distinct()


@query("run_metrics_table", _sql() + "SELECT model_name, run_id, run_name, version, status, metric, ROUND(value, 6) AS value FROM runs")
def run_metrics_table(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(run_table(spark, sf), "value")


@query("coalesce_metrics", _sql() + "SELECT model_name, run_id, version, status, ROUND(value, 6) AS value FROM f1s")
def coalesce_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(run_f1(run_table(spark, sf)), "value")


@query(
    "run_leaderboard",
    _sql()
    + """SELECT model_name, run_id, run_name, ROUND(max(value) FILTER (metric = 'accuracy'), 6) AS accuracy, ROUND(max(value) FILTER (metric = 'recall'), 6) AS recall
      FROM runs WHERE status = 'FINISHED' GROUP BY ALL ORDER BY max(value) FILTER (metric = 'accuracy') DESC NULLS LAST, run_id LIMIT 10""",
)
def run_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(registry.leaderboard(run_table(spark, sf), "accuracy", 10, ["recall"]), "accuracy", "recall")


@query(
    "best_per_group",
    _sql("b AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY value DESC NULLS LAST, run_id) AS rank FROM f1s WHERE status = 'FINISHED')")
    + "SELECT model_name, run_id, version, ROUND(value, 6) AS value, CAST(rank AS BIGINT) AS rank FROM b WHERE rank <= 2",
)
def best_per_group(spark: SparkSession, sf: str) -> DataFrame:
    finished = run_f1(run_table(spark, sf)).filter(F.col("status") == "FINISHED").drop("status")
    best = registry.best_per_group(finished, ["model_name"], "value", ["run_id"], 2)
    return best.withColumns({"value": half_up("value"), "rank": F.col("rank").cast("bigint")})


@query(
    "resolve_alias",
    _sql(
        _ALIASES,
        "o AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY CASE alias WHEN 'challenger' THEN 1 ELSE 2 END) AS k FROM aliases WHERE alias <> 'champion')",
    )
    + "SELECT model_name, alias, version, run_id, ROUND(value, 6) AS value FROM o JOIN f1s USING (model_name, version) WHERE k = 1",
)
def resolve_alias(spark: SparkSession, sf: str) -> DataFrame:
    runs = run_table(spark, sf)
    return rounded(registry.resolve_alias(alias_table(runs), versions(runs), run_f1(runs)), "value")


_REQUIRED = "champion_f1 * (1 + CAST(0.01 AS DOUBLE))"


@query(
    "quality_gate",
    _sql(_ALIASES, _PAIRS, f"g AS (SELECT *, {_REQUIRED} AS required, candidate_f1 >= 0.5 AS good, champion_f1 IS NULL OR candidate_f1 > {_REQUIRED} AS better FROM pairs)")
    + """SELECT model_name, challenger_version, champion_version, ROUND(candidate_f1, 6) AS candidate_f1, ROUND(champion_f1, 6) AS champion_f1, ROUND(required, 6) AS required_f1,
      CAST(good AS INT) AS minimum_quality_passed, CAST(better AS INT) AS beats_champion, CAST(good AND better AS INT) AS evaluation_passed FROM g""",
)
def quality_gate(spark: SparkSession, sf: str) -> DataFrame:
    judged = registry.quality_gate(pairs(run_table(spark, sf)), minimum=0.5)
    return rounded(judged, "candidate_f1", "champion_f1", "required_f1")


@query(
    "promote_decision",
    _sql(_ALIASES, _PAIRS, f"g AS (SELECT *, champion_f1 IS NULL OR candidate_f1 > {_REQUIRED} AS better FROM pairs)")
    + """SELECT model_name, CAST(better AS INT) AS promoted, champion_version AS old_champion_version,
      CASE WHEN better THEN challenger_version ELSE champion_version END AS new_champion_version, ROUND(champion_f1, 6) AS champion_metric,
      ROUND(candidate_f1, 6) AS challenger_metric, CASE WHEN better THEN 'champion' ELSE 'challenger' END AS challenger_phase,
      CASE WHEN champion_version IS NULL THEN NULL WHEN better THEN 'previous_champion' ELSE 'champion' END AS champion_phase FROM g""",
)
def promote_decision(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(registry.promote_decision(pairs(run_table(spark, sf))), "champion_metric", "challenger_metric")


@query(
    "next_aliases",
    _sql(_ALIASES, _PAIRS, f"g AS (SELECT model_name, CASE WHEN champion_f1 IS NULL OR candidate_f1 > {_REQUIRED} THEN challenger_version ELSE champion_version END AS v FROM pairs)")
    + "SELECT model_name, alias, version FROM aliases WHERE alias <> 'champion' UNION ALL SELECT model_name, 'champion', v FROM g",
)
def next_aliases(spark: SparkSession, sf: str) -> DataFrame:
    runs = run_table(spark, sf)
    return registry.next_aliases(alias_table(runs), registry.promote_decision(pairs(runs)))


@query(
    "segment_gate",
    with_sql(
        "seg AS (SELECT event_type AS segment, CAST(1 + user_id % 2 AS INT) AS model_version, CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS y_flag, "
        "CASE WHEN value >= 40 THEN 1 ELSE 0 END AS prediction FROM events)",
        counts_sql("seg", "segment, model_version"),
        f"f AS (SELECT segment, model_version, {WEIGHTED_F1} AS f FROM c)",
        "pair AS (SELECT segment, max(f) FILTER (model_version = 1) AS champion_f1, max(f) FILTER (model_version = 2) AS candidate_f1 FROM f GROUP BY segment)",
    )
    + f"""SELECT segment, ROUND(champion_f1, 6) AS champion_f1, ROUND(candidate_f1, 6) AS candidate_f1, ROUND({_REQUIRED}, 6) AS required_f1,
      CAST(candidate_f1 >= 0.55 AS INT) AS minimum_quality_passed, CAST(candidate_f1 > {_REQUIRED} AS INT) AS beats_champion,
      CAST(candidate_f1 >= 0.55 AND candidate_f1 > {_REQUIRED} AS INT) AS evaluation_passed FROM pair""",
)
def segment_gate(spark: SparkSession, sf: str) -> DataFrame:
    log = table(spark, sf, "events").select(
        F.col("event_type").alias("segment"),
        F.expr("CAST(1 + user_id % 2 AS INT)").alias("model_version"),
        F.expr("CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END").alias("y_flag"),
        F.expr("CASE WHEN value >= 40 THEN 1 ELSE 0 END").alias("prediction"),
    )
    quality = metrics.averaged_metrics(log, LABEL, PREDICTION, ["segment", "model_version"])
    judged = registry.segment_gate(quality, "segment", "model_version", champion=1, challenger=2, minimum=0.55)
    return rounded(judged, "champion_f1", "candidate_f1", "required_f1")


_WEIGHT = " + ".join(f"CAST(share >= {v} AS INT)" for v in registry._POISSON)


@query(
    "segment_gain_bounds",
    with_sql(
        "seg AS (SELECT event_id, event_type AS segment, 1 + user_id % 2 AS model_version, user_id % 3 = 0 AS y, value >= 40 AS p FROM events)",
        "drawn AS (SELECT *, CASE WHEN replica = 0 THEN 0 ELSE CAST(concat('0x', substr(md5(concat(event_id, '|', replica)), 1, 8)) AS BIGINT) END AS share FROM seg, range(41) r(replica))",
        f"each AS (SELECT *, CASE WHEN replica = 0 THEN 1 ELSE {_WEIGHT} END AS n FROM drawn)",
        """f AS (SELECT segment, replica, model_version, COALESCE(2 * sum(n) FILTER (y AND p) / NULLIF(CAST(COALESCE(sum(n) FILTER (p), 0) + COALESCE(sum(n) FILTER (y), 0) AS DOUBLE), 0), 0) AS f1
      FROM each GROUP BY ALL)""",
        "g AS (SELECT segment, replica, max(f1) FILTER (model_version = 1) AS champion_f1, max(f1) FILTER (model_version = 2) AS candidate_f1 FROM f GROUP BY ALL)",
    )
    + """SELECT segment, ROUND(max(champion_f1) FILTER (replica = 0), 6) AS champion_f1, ROUND(max(candidate_f1) FILTER (replica = 0), 6) AS candidate_f1,
      ROUND(max(candidate_f1 - champion_f1) FILTER (replica = 0), 6) AS gain,
      ROUND((list(candidate_f1 - champion_f1 ORDER BY candidate_f1 - champion_f1) FILTER (replica > 0))[2], 6) AS gain_low FROM g GROUP BY segment""",
)
def segment_gain_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """The gate's gain per segment with the lower end of its bootstrap interval."""
    log = table(spark, sf, "events").select(
        "event_id",
        F.col("event_type").alias("segment"),
        (1 + F.col("user_id") % 2).alias("model_version"),
        F.expr("CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END").alias("y_flag"),
        F.expr("CASE WHEN value >= 40 THEN 1 ELSE 0 END").alias("prediction"),
    )
    found = registry.segment_gain_bounds(log, "event_id", "segment", "model_version", 1, 2, LABEL, PREDICTION)
    return rounded(found, "champion_f1", "candidate_f1", "gain", "gain_low")


_RULE = "CASE WHEN duration + campaign * 10 > 200 + 20 * {version} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction"


@query(
    "score_with_alias",
    _sql(_ALIASES, CONTACTS, "chosen AS (SELECT max(version) AS version FROM aliases WHERE model_name = 'model-1' AND alias = 'champion')")
    + f"SELECT prediction, count(*) AS row_count FROM (SELECT {_RULE.format(version='version')} FROM contacts, chosen) GROUP BY prediction",
)
def score_with_alias(spark: SparkSession, sf: str) -> DataFrame:
    """The champion of one model scores the contacts; each stored version has a cutoff of its own."""
    runs, root, name = run_table(spark, sf), fresh_path(spark, "models"), "model-1"
    stored = [r.version for r in versions(runs).filter(F.col("model_name") == name).select("version").distinct().collect()]
    for version in stored:
        rule = SQLTransformer(statement=f"SELECT *, {_RULE.format(version=version)} FROM __THIS__")
        scoring.save_model(PipelineModel([rule]), root, name, version)
    source = contacts(spark, sf)
    inputs = {c: source.schema[c].dataType.simpleString() for c in ("duration", "campaign")}
    output = SnapshotTable(spark, fresh_path(spark, "predictions"))
    return scoring.score_with_alias(source, root, alias_table(runs), name, registry.CHAMPION, inputs, ["contact_key", "duration"], output)
