"""Batch ETL and analytics over tabular open data, written as PySpark jobs."""

__version__ = "1.0.0"
