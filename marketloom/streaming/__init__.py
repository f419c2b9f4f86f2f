"""Structured Streaming delivery of change feeds."""
