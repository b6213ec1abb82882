"""qaspark.sources."""
