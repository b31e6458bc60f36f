"""Structured Streaming variant of the bronze load (optional)."""
