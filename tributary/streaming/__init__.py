"""Structured Streaming jobs for the near-real-time path."""
