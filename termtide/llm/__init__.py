"""Operators for training-data pipelines: formatting, scans, near-duplicates, tokens, archives."""
