"""All registered queries."""

from clipwarden.plans import (  # noqa: F401
    frame_queries,
    join_queries,
    rule_queries,
    scalar_queries,
    source_queries,
    stream_queries,
    summary_queries,
)
from clipwarden.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
