"""Continuous sync."""
