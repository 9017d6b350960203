"""Readers, entity tables and sinks."""
