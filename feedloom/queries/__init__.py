"""Queries on the given tables, one per operator, each with the SQL that gives the same rows."""

from __future__ import annotations

from feedloom.queries import feeds, jobs, pages, records, texts  # noqa: F401  (fills the registry)
from feedloom.queries.registry import REGISTRY

__all__ = ["REGISTRY"]
