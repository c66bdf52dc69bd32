"""Query plans over the benchmark tables: Spark queries plus the equivalent SQL text."""
