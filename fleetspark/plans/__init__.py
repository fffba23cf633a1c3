"""Whole derivations put together from the operators."""
