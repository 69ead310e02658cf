"""Relational operators of the Silver and Gold layers."""
