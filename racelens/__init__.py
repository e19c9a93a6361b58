"""racelens: race split analytics expressed as Spark DataFrame plans.

Sub-packages
------------
functions  Column expressions over split names (distance, order, aliases, gender codes).
sources    Derived race tables, the catalog document, wide Parquet scans, manifests, sinks.
operators  Requests, history selection, training table, pair grid, estimators, gates, reports.
plans      The registry of named queries and their DuckDB oracle SQL.
streaming  Intentionally empty: the reference has no streaming work.
"""

__all__ = ["session"]
