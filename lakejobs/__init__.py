"""Layered-lakehouse data jobs as plain PySpark DataFrame code."""

__version__ = "0.1.0"
