"""Structured Streaming queries over the batch transforms."""
