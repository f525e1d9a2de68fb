"""Readers, writers, the dataset registry and the manifest."""
