"""Column expressions; every one is built from Spark's own functions."""
