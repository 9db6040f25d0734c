"""Lectern functions."""
