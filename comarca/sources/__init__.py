"""Readers for delimited files, workbooks, staged Parquet and catalog tables."""
