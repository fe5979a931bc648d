"""Bank reporting marts on Spark: loading, daily marts, a period report, repair jobs."""
