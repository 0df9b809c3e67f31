"""Structured Streaming form of the incremental mart."""
