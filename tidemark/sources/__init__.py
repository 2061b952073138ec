"""Scans: JDBC tables, CSV feeds, catalog tables, marker files."""
