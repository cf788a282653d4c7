"""Composites: feature tables, forecasts and serving results."""
