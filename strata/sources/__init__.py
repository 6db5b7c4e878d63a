"""Readers and writers (CSV, Parquet, tables, views)."""

from strata.sources.tables import read_table, source  # noqa: F401
