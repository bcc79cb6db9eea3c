"""Registered queries and their SQL twins."""

from __future__ import annotations

from textlake.catalog import registry
from textlake.catalog import features, reviews, sources, tables, text, training, vectors, vocab  # noqa: F401

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES
