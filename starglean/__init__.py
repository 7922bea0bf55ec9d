"""starglean: review-text analytics as Spark DataFrame, ML and streaming jobs."""
