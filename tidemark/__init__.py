"""Change events to lakehouse tables, as plain PySpark functions."""
