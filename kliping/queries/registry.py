"""Registry filled by the ``query`` decorator."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

GROUPS = ["ingest", "listing", "selection", "loading", "fields", "cleaning", "conversion", "repairs", "reports"]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        name = fn.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def days_as_text(df: DataFrame) -> DataFrame:
    """Show dates as text, so that clients of both engines see the same values."""
    return df.select(
        *[F.col(f.name).cast("string").alias(f.name) if f.dataType == DateType() else F.col(f.name) for f in df.schema]
    )


def load_all() -> None:
    for group in GROUPS:
        import_module(f"kliping.queries.{group}")
