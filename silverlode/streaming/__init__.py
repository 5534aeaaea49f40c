"""Structured Streaming jobs and their monitors."""
