"""The same ingest as Structured Streaming jobs."""
