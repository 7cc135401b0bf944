"""Member-panel analytics expressed as PySpark DataFrame operators."""
