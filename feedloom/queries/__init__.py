"""Queries over the driver tables, each with an independent SQL form where one exists."""

from __future__ import annotations

from feedloom.queries import logistics, posts, streams, tables, text
from feedloom.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "logistics", "posts", "streams", "tables", "text"]
