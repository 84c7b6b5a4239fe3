"""Layered real-time warehouse operators for PySpark DataFrames and Structured Streaming."""

__version__ = "0.1.0"
