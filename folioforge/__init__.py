"""Catalog and warehouse data jobs written as PySpark DataFrame plans."""

__version__ = "0.1.0"
