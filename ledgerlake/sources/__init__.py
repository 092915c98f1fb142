"""Readers: JSON feeds and layer tables."""
