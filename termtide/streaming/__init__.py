"""Streaming jobs; each result works on batch input as well."""
