"""Readers and writers: delimited text with contracts, HTML tables, grids, tables."""
