"""Column expressions. All are built from Spark's own functions."""
