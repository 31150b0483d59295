"""Operators of a training-data pipeline (filter, dedup, PII, archives, tokens, vectors)."""
