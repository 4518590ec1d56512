"""Market-data feed analytics written as Spark DataFrame jobs."""
