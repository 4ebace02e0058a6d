"""Monthly traffic analytics on Spark: bronze landing, silver facts, gold aggregates, network reports."""
