"""Market time-series analytics expressed as PySpark DataFrame operators."""
