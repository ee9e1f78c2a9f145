"""All registered queries."""

from kpimill.plans import (  # noqa: F401
    cube_queries,
    job_queries,
    lookup_queries,
    market_queries,
    scan_queries,
    shape_queries,
)
from kpimill.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
