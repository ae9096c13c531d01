"""The registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from galewright.plans import (  # noqa: F401  (importing registers the queries)
    features,
    joining,
    modelling,
    monitoring,
    projecting,
    quality,
    registry_queries,
    storage,
    streams,
    summaries,
)
from galewright.plans.registration import registered

__all__ = ["registered"]
