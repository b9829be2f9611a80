"""Observation sources: text lines and tables."""
