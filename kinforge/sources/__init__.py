"""Readers and writers of tab-separated tables, with file order kept as a column."""
