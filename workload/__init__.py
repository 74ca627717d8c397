"""Queries over the supplied tables, used by the checks and the benchmark."""

from workload import (  # noqa: F401
    feature_queries,
    metric_queries,
    quality_queries,
    request_queries,
    storage_queries,
    summary_queries,
)
from workload import model_queries  # noqa: F401  isort: skip  (the longest, run last)
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
