"""Importing this module registers every query."""

from folioweave.queries import cells, crawl, curation, dex, edges, io, learnsets, moves, scalars  # noqa: F401
from folioweave.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
