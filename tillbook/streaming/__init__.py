"""The incremental loads on Structured Streaming."""
