"""Structured Streaming entry points (landed-file refresh)."""
