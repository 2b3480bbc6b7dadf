"""Structured Streaming: arriving files, incremental matching, live metrics."""
