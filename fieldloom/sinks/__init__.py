"""Upsert and append sinks."""
