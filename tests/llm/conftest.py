from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from edge_rows import CLASHES, COLUMNS, EDGES  # noqa: E402

@pytest.fixture(scope="session")
def edges(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGES, COLUMNS).repartition(3)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="session")
def no_rows(spark):
    return spark.createDataFrame([], COLUMNS)


def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def docs(spark, sf):
    return documents(spark, sf)


@pytest.fixture(scope="session")
def entry():
    import __spark_entry__

    return __spark_entry__.queries()
