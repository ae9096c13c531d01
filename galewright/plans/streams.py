"""Streaming forms, run to completion over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galewright.operators.scoring import LinearModel
from galewright.plans.quality import ACCURACY, F1, LABEL, MODEL, PRECISION, PREDICTION, RECALL, TIME, counts_sql, rounded
from galewright.plans.registration import SCORED, query, with_sql
from galewright.session import fresh_path
from galewright.sources.fixtures import as_scored, scored_events, table
from galewright.sources.snapshots import SnapshotTable
from galewright.streaming import log, newest


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return log.read_stream(spark, sf, table(spark, sf, "events").schema, "events.parquet")


@query(
    "stream_daily_profile",
    with_sql(SCORED, "daily AS (SELECT date_trunc('day', inference_timestamp) AS window_start, * FROM scored)", counts_sql("daily", "window_start, model_version"))
    + f"""SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, model_version, n AS row_count, ROUND({ACCURACY}, 6) AS accuracy,
      ROUND({PRECISION}, 6) AS "precision", ROUND({RECALL}, 6) AS recall, ROUND({F1}, 6) AS f1 FROM c""",
)
def stream_daily_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Update mode into a keyed table: every window is there after each batch, none is held back."""
    profile = SnapshotTable(spark, fresh_path(spark, "daily-profile"))
    daily = log.daily_profile(as_scored(_events(spark, sf)), TIME, MODEL, LABEL, PREDICTION)
    sink = log.upsert_sink(profile, ["window_start", "window_end", MODEL], "daily-profile")
    log.run_available(daily, sink, fresh_path(spark, "stream"), mode="update")
    return rounded(profile.as_of(), "accuracy", "precision", "recall", "f1")


def event_model() -> LinearModel:
    return LinearModel(-0.9071, {"balance": 0.0173}, {"job": {"purchase": 0.611, "error": -0.507}})


_SCORE = """1 / (1 + exp(-(CAST(-0.9071 AS DOUBLE) + balance * CAST(0.0173 AS DOUBLE)
  + CASE job WHEN 'purchase' THEN CAST(0.611 AS DOUBLE) WHEN 'error' THEN CAST(-0.507 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)))"""


@query(
    "stream_score",
    with_sql(SCORED) + f"SELECT event_id, ROUND({_SCORE}, 6) AS score, CASE WHEN {_SCORE} >= 0.5 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction FROM scored",
)
def stream_score(spark: SparkSession, sf: str) -> DataFrame:
    model = event_model()
    scored = as_scored(_events(spark, sf)).select(
        "event_id", F.round(model.score(), 6).alias("score"), model.prediction().alias("prediction")
    )
    path = fresh_path(spark, "stream-scores")
    log.append_files(scored, path, fresh_path(spark, "stream"))
    return spark.read.schema(scored.schema).parquet(path)


@query(
    "stream_label_backfill",
    with_sql(SCORED)
    + "SELECT event_id, job, prediction, CASE WHEN job = 'click' THEN 1 - y_flag ELSE y_flag END AS y_flag FROM scored",
)
def stream_label_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """The log stays as it was written; labels arrive beside it and meet it when it is read."""
    logged = scored_events(spark, sf).select("event_id", "job", "prediction", "y_flag")
    late = as_scored(_events(spark, sf)).filter(F.col("job") == "click").select("event_id", (1 - F.col("y_flag")).alias("y_flag"), TIME)
    path = fresh_path(spark, "late-labels")
    newest.append_newest(late, path, fresh_path(spark, "stream"), ["event_id"], TIME)
    labels = newest.newest(spark, path, late.schema, ["event_id"], TIME)
    return newest.with_late(logged, labels, ["event_id"], ["y_flag"])


@query(
    "stream_feature_upsert",
    """SELECT user_id, event_type, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, value DESC, event_id DESC) AS r FROM events)
      WHERE r = 1""",
)
def stream_feature_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The newest value per user and event type."""
    arriving = _events(spark, sf).select("user_id", "event_type", "ts", "value")
    path = fresh_path(spark, "newest")
    newest.append_newest(arriving, path, fresh_path(spark, "stream"), ["user_id", "event_type"], "ts")
    return newest.newest(spark, path, arriving.schema, ["user_id", "event_type"], "ts")
