"""Structured Streaming loads: file ingest, watermark de-duplication, vault merge."""
