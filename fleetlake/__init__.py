"""Layered trip analytics on Spark: landing, raw, trusted, refined and quality."""
