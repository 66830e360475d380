"""Feeds as an incremental file stream."""
