"""All registered queries."""

from . import catalog_filter, catalog_flat, catalog_gap, catalog_log, catalog_plan  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
