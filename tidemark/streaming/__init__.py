"""Once-only ingest of landed files with Structured Streaming."""
