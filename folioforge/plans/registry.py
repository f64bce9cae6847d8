"""All core queries by name, and the SQL that checks them."""

from __future__ import annotations

from folioforge.plans import check_queries, message_queries, nested_queries, record_queries, table_queries, text_queries  # noqa: F401  they register their queries
from folioforge.plans.catalog import ORACLES, QUERIES

QUERIES.update(nested_queries.QUERIES)
ORACLES.update(nested_queries.ORACLES)

__all__ = ["ORACLES", "QUERIES"]
