"""Incremental jobs: price or cap rows as they arrive, use up one-time offers."""
