"""Streaming: incremental refresh with Structured Streaming."""
