"""Structured Streaming pick-up of newly arrived files."""
