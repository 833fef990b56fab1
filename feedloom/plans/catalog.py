"""Catalog of the engine's queries with their SQL."""

from __future__ import annotations

from feedloom.plans import deal_queries, flow_queries, record_queries, report_queries, text_queries
from feedloom.plans.registry import Query

_PARTS = (text_queries.R, deal_queries.R, flow_queries.R, report_queries.R, record_queries.R)


def queries() -> dict[str, Query]:
    return {k: f for part in _PARTS for k, f in part.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for part in _PARTS for k, s in part.sql.items()}
