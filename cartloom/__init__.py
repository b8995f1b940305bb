"""Commerce analytics as PySpark DataFrame programs."""
