"""Operators of a training-data pipeline: scans, scores, dedup, mixing, token files."""
