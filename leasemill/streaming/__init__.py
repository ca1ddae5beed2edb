"""Structured Streaming forms of ingestion and profiling."""
