"""Structured Streaming jobs: incremental keyed upserts of landed change files."""
