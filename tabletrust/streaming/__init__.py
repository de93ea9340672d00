"""Structured Streaming versions of the run-state operators."""
