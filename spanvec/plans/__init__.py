"""Queries over the given tables, one per operator."""

from __future__ import annotations

from spanvec.plans.base import ORACLES, QUERIES, Plan


def _load() -> None:
    from spanvec.plans import (  # noqa: F401
        function_plans,
        metric_plans,
        quality_plans,
        search_plans,
        storage_plans,
        table_plans,
    )


def all_queries() -> dict[str, Plan]:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
