"""Readers and the role views over the driver tables."""
