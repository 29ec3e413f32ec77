"""Operators: models, data quality, ingest, fraud and reconciliation."""
