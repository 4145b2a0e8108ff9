"""Continuous form of the document sync (Structured Streaming)."""
