"""Relational operators over time-aligned text and interval data."""
