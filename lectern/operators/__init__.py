"""Lectern operators."""
