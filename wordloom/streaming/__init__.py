"""Structured Streaming jobs over message logs and article feeds."""
