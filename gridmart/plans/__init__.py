"""Whole jobs: models, quality summary, ingest."""
