"""clicklens: clickstream and ad-log analytics as Spark DataFrame / Structured Streaming operators.

Every operator takes DataFrames and named parameters and returns a DataFrame built only from
built-in column expressions, so Catalyst plans the whole query (pushdown, pruning, partial
aggregation, per-group limits) and nothing passes through the driver.
"""

from clicklens.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
