"""Structured Streaming versions of the stateful training-log operators."""
