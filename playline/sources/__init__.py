"""Readers of raw files."""
