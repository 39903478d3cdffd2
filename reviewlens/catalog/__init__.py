"""Registered queries over the test tables, each with its check in SQL where SQL can express it."""

from __future__ import annotations

from reviewlens.catalog import corpora, evaluation, features, models, sampling, sources, text
from reviewlens.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "corpora", "evaluation", "features", "models", "sampling", "sources", "text"]
