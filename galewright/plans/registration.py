"""Registration of queries and the SQL fragments they share."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from galewright.sources.fixtures import CONTACT_COLUMNS, SCORED_COLUMNS

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None


_QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query. Without ``sql`` it is checked by the tests only."""

    def register(build: Build) -> Build:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = Query(name, build, sql.strip() if sql else None)
        return build

    return register


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def _projection(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in columns.items())


CONTACTS = f"contacts AS (SELECT {_projection(CONTACT_COLUMNS)} FROM orders JOIN customer ON o_custkey = c_custkey)"
SCORED = f"scored AS (SELECT {_projection(SCORED_COLUMNS)} FROM events)"

TIER = """tier AS (
  SELECT contacts.*,
    CASE WHEN y = 'yes' THEN 1 ELSE 0 END AS y_flag,
    CASE WHEN age < 30 THEN 'young' WHEN age < 45 THEN 'adult' WHEN age < 60 THEN 'middle_age' ELSE 'senior' END AS age_group,
    CASE WHEN balance < 0 THEN 'negative' WHEN balance < 300 THEN 'low' WHEN balance < 1000 THEN 'medium' ELSE 'high' END AS balance_tier,
    CASE WHEN campaign <= 1 THEN 'low' ELSE 'high' END AS contact_intensity,
    CASE WHEN pdays = -1 THEN 0 ELSE 1 END AS was_previously_contacted,
    CASE WHEN pdays = -1 THEN 0 WHEN pdays <= 30 THEN 3 WHEN pdays <= 180 THEN 2 ELSE 1 END AS recency_score,
    CASE WHEN duration < 120 THEN 'short' WHEN duration < 300 THEN 'medium' ELSE 'long' END AS duration_bucket,
    CASE WHEN balance < 0 OR (housing = 'yes' AND loan = 'yes') THEN 'high'
         WHEN housing = 'yes' OR loan = 'yes' THEN 'medium' ELSE 'low' END AS financial_stress
  FROM contacts WHERE age >= 18)"""

CUT = """cut AS (
  SELECT contacts.*,
    CASE WHEN y = 'yes' THEN 1 ELSE 0 END AS y_flag,
    CASE WHEN age > 0 AND age <= 30 THEN 'young' WHEN age > 30 AND age <= 45 THEN 'adult'
         WHEN age > 45 AND age <= 60 THEN 'middle_age' WHEN age > 60 AND age <= 120 THEN 'senior' ELSE 'nan' END AS age_group,
    CASE WHEN balance > -999999 AND balance <= 0 THEN 'negative' WHEN balance > 0 AND balance <= 300 THEN 'low'
         WHEN balance > 300 AND balance <= 1000 THEN 'medium' WHEN balance > 1000 AND balance <= 999999 THEN 'high'
         ELSE 'nan' END AS balance_tier,
    CASE WHEN campaign <= 1 THEN 'low' ELSE 'high' END AS contact_intensity,
    CASE WHEN pdays <> -1 THEN 1 ELSE 0 END AS was_previously_contacted,
    CASE WHEN pdays = -1 THEN 0 WHEN pdays <= 30 THEN 3 WHEN pdays <= 180 THEN 2 ELSE 1 END AS recency_score,
    CASE WHEN duration > 0 AND duration <= 120 THEN 'short' WHEN duration > 120 AND duration <= 300 THEN 'medium'
         WHEN duration > 300 AND duration <= 999999 THEN 'long' ELSE 'nan' END AS duration_bucket,
    CASE WHEN balance < 0 OR (housing = 'yes' AND loan = 'yes') THEN 'high'
         WHEN housing = 'yes' OR loan = 'yes' THEN 'medium' ELSE 'low' END AS financial_stress
  FROM contacts WHERE age >= 18)"""

RATIO = """ratio AS (
  SELECT contacts.*,
    CASE WHEN age <= 30 THEN 'young' WHEN age <= 50 THEN 'middle' WHEN age <= 65 THEN 'senior' ELSE 'elderly' END AS age_group,
    CASE WHEN balance < 0 THEN 'negative' WHEN balance < 500 THEN 'low' WHEN balance <= 2000 THEN 'medium' ELSE 'high' END AS balance_tier,
    ROUND(CAST(campaign AS DOUBLE) / (previous + CAST(1 AS DOUBLE)), 6) AS contact_intensity,
    CASE WHEN pdays <> -1 THEN 1 ELSE 0 END AS was_previously_contacted,
    CASE WHEN pdays = -1 THEN CAST(0 AS DOUBLE) ELSE ROUND(CAST(1 AS DOUBLE) / (pdays + 1), 6) END AS recency_score,
    CASE WHEN duration < 60 THEN 'very_short' WHEN duration < 180 THEN 'short' WHEN duration <= 500 THEN 'medium' ELSE 'long' END AS duration_bucket,
    CASE WHEN housing = 'yes' AND loan = 'yes' THEN 1 ELSE 0 END AS financial_stress
  FROM contacts)"""


def with_sql(*parts: str) -> str:
    """A WITH clause of the given named queries."""
    return "WITH " + ",\n".join(parts) + "\n"


def digest_sql(key: str, salt: str | int) -> str:
    return f"md5(concat(CAST({key} AS VARCHAR), '|{salt}'))"


def share_sql(key: str, salt: str | int, share: float) -> str:
    """Is the digest's first 32 bits, as a number, below the share of 2³²?"""
    return f"(CAST(concat('0x', substr({digest_sql(key, salt)}, 1, 8)) AS BIGINT) < {round(share * 2**32)})"


def columns_sql(columns: Sequence[str]) -> str:
    return ", ".join(columns)
