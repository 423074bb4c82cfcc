"""Structured Streaming forms of the periodic jobs."""
