"""Sequence-recommendation analytics as lazy PySpark plans."""
