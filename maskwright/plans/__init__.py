"""Named queries and session settings. Importing this package registers the queries."""

from maskwright.plans import (  # noqa: F401
    audit_queries,
    enrich_queries,
    find_queries,
    io_queries,
    mask_queries,
    restore_queries,
)
from maskwright.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
