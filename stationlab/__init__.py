"""Station-observation analytics as PySpark DataFrame operators."""
