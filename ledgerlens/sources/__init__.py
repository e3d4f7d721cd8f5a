"""Readers of raw files and the layered table store."""
