"""Named queries over the given tables, each beside its ANSI SQL twin."""

from kliping.queries.registry import ORACLE, QUERIES, load_all

__all__ = ["ORACLE", "QUERIES", "load_all"]
