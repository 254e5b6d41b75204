"""Tabular data jobs expressed as Spark DataFrame plans."""
