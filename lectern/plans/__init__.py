"""Lectern plans."""
