"""Lectern streaming."""
