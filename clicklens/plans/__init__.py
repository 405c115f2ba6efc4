from clicklens.plans.oracle import oracle_sql
from clicklens.plans.registry import batch_queries, entry, queries

__all__ = ["batch_queries", "entry", "oracle_sql", "queries"]
