"""Spark jobs that turn tables of raw news pages into one article table.

The public modules below take DataFrames and return DataFrames (or Columns);
none of them brings rows to the driver.
"""

from kliping.functions import cleanup as clean
from kliping.functions import dates as convert
from kliping.operators import audit, dedupe, extract, filters, links, repair
from kliping.plans import articles, listings as plan
from kliping.sources import store
from kliping.streaming import ingest as stream

__all__ = [
    "articles",
    "audit",
    "clean",
    "convert",
    "dedupe",
    "extract",
    "filters",
    "links",
    "plan",
    "repair",
    "store",
    "stream",
]
