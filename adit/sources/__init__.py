"""Readers for raw documents, delimited files, event lists and JSON records."""
