"""Structured Streaming form of the loader (H1-H3)."""
