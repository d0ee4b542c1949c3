"""News-fragment reconstruction and analytics on PySpark."""
