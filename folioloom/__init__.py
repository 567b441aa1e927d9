"""Market and fund analytics as plain Spark DataFrame jobs."""
