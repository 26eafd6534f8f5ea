"""All registered queries; importing the query modules fills the registry."""

from __future__ import annotations

from wharfline.plans import (  # noqa: F401
    dashboard_queries,
    forecast_queries,
    file_queries,
    inventory_queries,
    ml_queries,
    network_queries,
    order_queries,
    quality_queries,
    series_queries,
)
from wharfline.plans.registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
