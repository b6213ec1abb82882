"""qaspark.operators."""
