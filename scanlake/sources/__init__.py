"""Inputs: JSON records, listing pages, file inventories, Parquet tables."""
