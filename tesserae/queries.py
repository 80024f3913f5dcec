"""The registry of the library's own queries and their SQL."""

from __future__ import annotations

from .plans import changes, graph, measures, outlines, pages, runs, texts  # noqa: F401
from .plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
