"""Readers, the canonical fact schema, and writers."""
