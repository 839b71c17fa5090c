"""Structured Streaming jobs for the event path."""
