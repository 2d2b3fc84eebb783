"""Registered queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from factline.queries import chunks, compare, evidence, integrity, runs, surface, text
from factline.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "chunks", "compare", "evidence", "integrity", "runs", "surface", "text"]
