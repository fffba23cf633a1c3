"""Landed files as DataFrames."""
