"""Registered queries: each runs over whole tables and carries its SQL twin where one exists."""

from driftline.queries import climate, io, lookup, placement, profiling, relational, search, streams  # noqa: F401
from driftline.queries.registry import REGISTRY

__all__ = ["REGISTRY"]
