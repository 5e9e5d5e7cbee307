"""Structured Streaming jobs: file ingest, daily counts, status audit."""
