"""Stored results."""
