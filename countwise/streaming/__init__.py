"""Structured Streaming versions of the frequency statistics."""
