"""Structured Streaming forms of the ticker feed and of the daily counts."""
