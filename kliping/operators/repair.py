"""Repairs of stored articles: find rows, recompute, merge by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kliping.functions import urls
from kliping.operators import dedupe, extract


def candidates(store: DataFrame, predicate: Column, columns: Sequence[str] = ("id", "url", "source")) -> DataFrame:
    """Rows that need a repair, with only the columns a repair reads."""
    return store.filter(predicate).select(*columns)


def merge(store: DataFrame, fixes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The store with the fixed columns put in place.

    A NULL fix leaves the stored value. Of several fixes of a key each column
    takes its largest value, so no stored row is ever doubled.
    """
    renamed = fixes.groupBy(key).agg(*[F.max(c).alias(f"_fix_{c}") for c in columns])
    joined = store.join(renamed, key, "left")
    kept = [
        F.coalesce(F.col(f"_fix_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in store.columns
    ]
    return joined.select(*kept)


def widen(fixes: DataFrame, columns: Sequence[str], key: str = "id") -> DataFrame:
    """Turn ``key, column, new_value`` rows into one row per key."""
    picked = [
        F.max(F.when(F.col("column") == c, F.col("new_value"))).alias(c) for c in columns
    ]
    return fixes.groupBy(key).agg(*picked)


def recompute(
    wanted: DataFrame, pages: DataFrame, rules: DataFrame, columns: Sequence[str], key: str = "url_key"
) -> DataFrame:
    """Fixes for the wanted rows, taken again from their pages.

    The pages are narrowed to the wanted addresses before their markup is read.
    Rejected pages and empty values fix nothing; of copies of a page the first
    accepted one counts, by ``page_id`` if there is one, else by address.
    """
    keyed = pages.withColumn(key, urls.canonical(F.col("url")))
    again = extract.extract_fields(keyed.join(wanted.select(key), key, "left_semi"), rules)
    values = [
        F.when(F.col(c) != "", F.col(c)).alias(c) if c != "pubdate" else F.col(c) for c in columns
    ]
    accepted = again.filter(F.col("reject_reason").isNull())
    return dedupe.first_by_key(accepted, key, ["page_id" if "page_id" in again.columns else "url"]).select(key, *values)
