"""Operators of a training-data pipeline: language, quality, near-duplicates, tokens, packing."""

from galewright.llm.catalog import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
