"""Batch analytics over trip records: profile, clean, encode, train, score, evaluate."""
