from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

TESTDATA = Path(os.environ.get("GALEWRIGHT_TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    from galewright.session import build_session

    session = build_session("galewright-tests", master="local[8]", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return str(TESTDATA / "sf0.01")


@pytest.fixture(scope="session")
def tiny():
    return str(TESTDATA / "sf0.001")


def final_plan(df) -> str:
    """The physical plan before execution."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="session")
def plan_of():
    return final_plan
