"""Sinks and table maintenance."""
