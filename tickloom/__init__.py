"""Option-tick, log, media and metric analytics expressed as Spark DataFrame jobs."""
