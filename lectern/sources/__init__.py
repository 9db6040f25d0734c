"""Lectern sources."""
