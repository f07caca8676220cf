"""All registered queries.  Importing a query module registers what it defines."""

from __future__ import annotations

from stratiform.plans import (  # noqa: F401
    discovery_queries,
    feature_queries,
    gold_queries,
    history_queries,
    layer_queries,
    quality_queries,
    report_queries,
    silver_queries,
    source_queries,
)
from stratiform.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
