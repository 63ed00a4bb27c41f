"""A retail sales mart on PySpark: clean, load, check, measure and segment sales."""
