"""Structured Streaming front of the landing folder."""
