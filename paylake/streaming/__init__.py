"""Structured Streaming jobs: landing, keyed dedup, live windows."""
