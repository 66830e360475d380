"""Readers: CSV feeds, page snapshots, element documents, catalogues, instructions."""
