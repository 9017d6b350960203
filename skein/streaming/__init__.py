"""Structured Streaming over stage event logs."""
