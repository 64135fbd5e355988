"""All interval, region, evaluation, metadata and learning queries with their DuckDB equivalents."""

from lociq.plans import interval_queries, learning_queries, locus_queries, region_queries, scalar_queries, source_queries, whole_queries  # noqa: F401
from lociq.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401
