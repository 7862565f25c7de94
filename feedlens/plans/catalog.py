"""All registered queries: importing the modules below fills the registry."""

from __future__ import annotations

from feedlens.plans import (  # noqa: F401
    cache_queries,
    change_queries,
    content_queries,
    event_queries,
    function_queries,
    incremental_queries,
    index_queries,
    recommend_queries,
    report_queries,
    stream_queries,
)
from feedlens.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
