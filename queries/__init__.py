"""Queries over the test tables, one or more per operator, with the SQL that must agree."""

from queries import aggregates, checks, documents, normalisers, readers, relations, scalars
from queries.registry import QUERIES

__all__ = [
    "QUERIES",
    "aggregates",
    "checks",
    "documents",
    "normalisers",
    "readers",
    "relations",
    "scalars",
]
