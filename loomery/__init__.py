"""loomery: Spark-first analytics over site audits, search hits and texts."""
