"""Structured Streaming forms of the upsert and of late-week handling."""
