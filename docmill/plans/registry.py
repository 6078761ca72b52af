"""All registered queries of the engine and their SQL equivalents."""

from __future__ import annotations

from docmill.plans import dataset_queries, record_queries, statistics_queries, text_queries  # noqa: F401  registration
from docmill.plans.catalog import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
