"""qaspark.streaming."""
