"""All registered queries and oracle statements."""

from campaignlake.plans import (  # noqa: F401
    evaluation_queries,
    feature_queries,
    model_queries,
    quality_queries,
    report_queries,
    segment_queries,
    stats_queries,
)
from campaignlake.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
