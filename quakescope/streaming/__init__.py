"""Structured Streaming consumer of the event topic (read side of the producer)."""
