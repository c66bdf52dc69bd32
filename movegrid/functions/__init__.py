"""Column-level helpers (all built on ``pyspark.sql.functions``; no UDFs)."""
