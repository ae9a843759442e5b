"""Operators: queries, pricing, settlement, reports, integrity checks."""
