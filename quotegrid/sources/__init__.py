"""Catalogue flatteners, landing sink and table sinks."""
