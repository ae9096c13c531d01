"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores. Each query
runs once to warm up and then BENCH_RUNS times (default 2); the fastest run counts. Results go to
the ``noop`` sink, so every row is computed and none is sent to the driver.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from galewright.plans import registered
from galewright.session import build_session
from galewright.sources.fixtures import contacts

HEADLINE = (
    "class_balance",
    "preset_v1_tier",
    "preset_v1_cut",
    "preset_v2_ratio",
    "merge_upsert",
    "change_feed",
    "global_row_number",
    "stable_key",
    "feature_lookup",
    "feature_lookup_hot",
    "feature_upsert",
    "stratified_split",
    "profile_sliced",
    "profile_columns",
    "column_profile",
    "drift_js",
    "drift_windows",
    "roc_auc",
    "weighted_macro_metrics",
    "score_linear",
    "batch_score",
    "train_logistic",
    "stream_daily_profile",
)


def seconds(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def best(build, runs: int) -> float:
    seconds(build)
    return round(min(seconds(build) for _ in range(runs)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("galewright-bench", master=f"local[{cpus}]", shuffle_partitions=cpus)
    plans = registered()
    times = {name: best(lambda: plans[name].build(spark, sf_dir), runs) for name in HEADLINE}

    def naive_row_number():
        order = ["age", "job", "balance", "duration", "campaign", "pdays", "previous", "y", "contact_key"]
        return contacts(spark, sf_dir).withColumn("n", F.row_number().over(Window.orderBy(*order)))

    found = re.search(r"sf([0-9.]+)", sf_dir)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "comparison": {"single_task_row_number": best(naive_row_number, runs)},
        "sf": float(found.group(1)) if found else None,
        "cpus": cpus,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
