"""Layered (bronze, silver, gold) star-schema analytics on PySpark."""
