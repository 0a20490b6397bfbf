"""Whole jobs: ingest, clean, score, keep history, compare."""
