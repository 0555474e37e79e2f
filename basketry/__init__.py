"""Retail transaction analytics written as plain PySpark DataFrame jobs."""
