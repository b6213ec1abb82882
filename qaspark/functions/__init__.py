"""qaspark.functions."""
