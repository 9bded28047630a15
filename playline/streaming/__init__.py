"""Incremental load as a file stream."""
