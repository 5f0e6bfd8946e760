"""The runnable queries over the given tables. Importing this package fills the registry."""

from onefold.workload import q_aggregates, q_clean, q_jobs, q_links, q_sources  # noqa: F401
from onefold.workload.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
