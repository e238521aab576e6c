"""Structured Streaming jobs: the batch expressions over files as they arrive."""
