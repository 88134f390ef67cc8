"""Pipelines built from the operators, and the named query catalogue."""
