"""Structured Streaming jobs over message streams."""
