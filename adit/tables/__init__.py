"""Stored tables: snapshots, edits, audit and SQL."""
