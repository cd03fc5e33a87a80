"""Structured Streaming word pipelines."""
