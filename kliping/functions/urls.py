"""URL handling as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical(url: Column) -> Column:
    """One key per article: no fragment, no whole-article variant, no trailing slash.

    ``page=all`` is the one query that sites add to fetch an article whole;
    every other parameter may tell articles apart and stays.
    """
    whole = F.regexp_replace(F.regexp_replace(url, r"#.*$", ""), r"([?&])page=all(&|$)", "$1")
    return F.rtrim(F.regexp_replace(whole, r"[?&]+$", ""), F.lit("/"))


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z]+://([^/?#]+)", 1)


def base(url: Column) -> Column:
    return F.regexp_extract(url, r"^([a-z]+://[^/?#]+)", 1)


def segments(url: Column) -> Column:
    """Path segments without scheme and host."""
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[a-z]+://[^/?#]+/?", "")
    return F.filter(F.split(path, "/"), lambda s: s != "")


def absolute(url: Column, prefix: Column) -> Column:
    """Put a prefix before links that have no scheme of their own."""
    return F.when(url.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://"), url).otherwise(F.concat(prefix, url))


def has_segment(url: Column, words: list[str]) -> Column:
    """True where one of the words is a whole path segment."""
    return F.arrays_overlap(F.split(url, "/"), F.array(*[F.lit(w) for w in words]))
