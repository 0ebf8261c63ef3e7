"""Structured Streaming: micro-batch validation into the tables."""
