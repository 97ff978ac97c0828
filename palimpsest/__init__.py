"""Document-evidence analytics as PySpark DataFrame plans."""
