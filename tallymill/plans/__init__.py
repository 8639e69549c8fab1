"""Composite pipelines."""
