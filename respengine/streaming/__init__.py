"""Streaming scoring."""
