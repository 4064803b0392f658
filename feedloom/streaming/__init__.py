"""Structured Streaming jobs that reuse the batch transforms."""
