"""Scans and sinks: typed driver tables, changelog text, bronze table, .tbl and result CSV."""
