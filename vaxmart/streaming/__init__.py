"""Structured Streaming ingestion of landing files."""
