"""Incident analytics on Spark: documents and telemetry in, typed incident tables and measures out."""
