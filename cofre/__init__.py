"""Batch lakehouse analytics for bank data on PySpark."""
