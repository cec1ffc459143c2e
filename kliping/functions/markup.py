"""Values read from markup by pattern, for rules that need no node array."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def attribute(html: Column, tag: str, name: str) -> Column:
    """An attribute of the first element of a tag that carries it, else NULL."""
    return F.get(F.regexp_extract_all(html, F.lit(rf'(?i)<{tag}\b[^>]*?\b{name}\s*=\s*["\']([^"\']*)["\']'), F.lit(1)), 0)


def meta_content(html: Column, name: str, attr: str = "(?:property|name|itemprop)") -> Column:
    """Content of a named meta tag, whichever attribute comes first."""
    before = rf'(?i)<meta\b[^>]*?\b{attr}\s*=\s*["\']{name}["\'][^>]*?\bcontent\s*=\s*["\']([^"\']*)["\']'
    after = rf'(?i)<meta\b[^>]*?\bcontent\s*=\s*["\']([^"\']*)["\'][^>]*?\b{attr}\s*=\s*["\']{name}["\']'
    first, second = (F.get(F.regexp_extract_all(html, F.lit(p), F.lit(1)), 0) for p in (before, after))
    return F.coalesce(first, second)


def fallback(*choices: Column) -> Column:
    """The first choice that is neither missing nor empty; '' without one."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices], F.lit(""))


def breadcrumb(parts: Column, n: int) -> Column:
    """The n-th part, from the end for negative n; NULL when out of range."""
    return F.try_element_at(parts, F.lit(n))


def tag_list(parts: Column, remove: str = "#") -> Column:
    """Many texts as one comma list."""
    return F.replace(F.array_join(parts, ","), F.lit(remove), F.lit(""))
