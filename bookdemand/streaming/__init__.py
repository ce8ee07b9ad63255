"""Structured Streaming forms of the booking operators (S-1 … S-8)."""
