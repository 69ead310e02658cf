"""Streaming load of landed files."""
