"""File-arrival ingestion with Structured Streaming."""
