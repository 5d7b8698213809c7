"""Demand analytics over posting-style records, as PySpark DataFrame plans."""

__version__ = "0.1.0"
