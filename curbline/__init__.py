"""Layered trip analytics on Spark: detail, aggregate and report tables."""
