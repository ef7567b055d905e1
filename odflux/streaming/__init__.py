"""Structured Streaming queries over the trip event stream."""
