"""Pages as a stream: each page file is read once, each address stored once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kliping.functions import urls
from kliping.operators import extract, links
from kliping.rules.listings import assign_site
from kliping.schema import PAGE
from kliping.sources import keys, manifest, store

FETCHED = T.StructType([*PAGE.fields, T.StructField("fetched_at", T.TimestampType())])


def read_page_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files of a page folder, in bounded batches."""
    return spark.readStream.schema(FETCHED).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def distinct_pages(pages: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drop copies of a page, same address and same markup, that arrive within ``delay``.

    The watermark follows the time of arrival, behind which no page can be, so
    none is late, however old it is. Only equal markup counts as a copy: it
    would be rejected or accepted alike, so a bad page never hides a good one.
    Later copies are left to the store.
    """
    keyed = pages.withColumns(
        {
            "url_key": urls.canonical(F.col("url")),
            "_arrived": F.current_timestamp(),
            "_markup": F.sha2(F.coalesce("html", F.lit("")), 256),
        }
    )
    return keyed.withWatermark("_arrived", delay).dropDuplicatesWithinWatermark(["url_key", "_markup"]).drop("_arrived", "_markup")


def _passed_on(delay: dt.timedelta, keep: dt.timedelta) -> Callable:
    """Passes a page on unless the same markup of its address was fetched within ``delay`` of it.

    State per address: of each markup the first and last fetch of its latest run of copies.
    """
    seconds, kept_for = delay.total_seconds(), int(keep.total_seconds() * 1000)

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        runs = {m: (a, b) for m, a, b in zip(*state.get, strict=True)} if state.exists else {}
        for frame in frames:
            frame = frame.sort_values("page_id", kind="stable")
            passed = []
            for markup, at in zip(frame["markup"], frame["at"], strict=True):
                first, last = runs.get(markup, (None, None))
                near = first is not None and first - seconds <= at <= last + seconds
                passed.append(not near)
                if near:
                    runs[markup] = min(first, at), max(last, at)
                elif first is None or at > last:  # an older page than those known is late: it goes on and leaves the state as it is
                    runs[markup] = at, at
            yield frame[passed]
        state.update((list(runs), [a for a, _ in runs.values()], [b for _, b in runs.values()]))
        state.setTimeoutDuration(kept_for)

    return run


IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def pages_by_event_time(pages: DataFrame, delay: dt.timedelta = dt.timedelta(days=1), keep: dt.timedelta = dt.timedelta(days=30)) -> DataFrame:
    """Drop copies of a page, same address and same markup, fetched within ``delay`` of each other.

    Time is the time of the fetch. Nothing is dropped for being late: a page far older than those before it is no copy
    of them, and the store decides what becomes of it. Pages without a fetch time count as fetched at the epoch. The
    state of an address expires by itself once it was not met for ``keep``, so it grows with the addresses met in that
    time only. A query that stops once all files are read needs ``IDLE_BATCHES`` off in its session, or it goes on
    looking for expired state; what is due then expires in the next run.
    """
    keyed = pages.withColumns(
        {
            "url_key": F.coalesce(urls.canonical(F.col("url")), F.lit("")),
            "markup": F.sha2(F.coalesce("html", F.lit("")), 256),
            "at": F.coalesce(F.unix_micros("fetched_at"), F.lit(0)) / 1e6,
        }
    )
    held = "markups array<string>, firsts array<double>, lasts array<double>"
    grouped = keyed.groupBy("url_key").applyInPandasWithState(
        _passed_on(delay, keep), keyed.schema, held, "append", GroupStateTimeout.ProcessingTimeTimeout
    )
    return grouped.drop("markup", "at")


def load_batch(batch: DataFrame, rules: DataFrame, store_path: str, found: DataFrame | None = None) -> DataFrame:
    """Extract and insert one batch; the same batch again inserts nothing.

    ``found`` holds the listing links, whose categories go with their pages. Stored addresses are looked up once, in the
    key index; the insert looks again only if another writer came in between.
    """
    spark = batch.sparkSession
    pages = batch if "site" in batch.columns else assign_site(batch)
    if found is not None:
        pages = links.pages_with_links(pages, found)
    keyed = pages.withColumn("url_key", urls.canonical(F.col("url")))
    at = manifest.version(spark, store_path)
    fresh = keyed.join(keys.stored(keyed.select("url_key"), store_path), "url_key", "left_anti")
    fields = extract.extract_fields(fresh.select("page_id", "site", "url", "html", *[c for c in links.CARRIED if c in fresh.columns]), rules)
    return store.insert_if_absent(fields, store_path, "page_id", checked=at)


def ingest(
    spark: SparkSession,
    pages_path: str,
    store_path: str,
    checkpoint: str,
    rules: DataFrame,
    files_per_batch: int = 1000,
    delay: str | dt.timedelta | None = None,
    found: DataFrame | None = None,
    compact_every: int = 50,
) -> StreamingQuery:
    """Load all page files not read yet, then stop.

    The checkpoint remembers the files; the anti join with the store makes a
    batch that is run again after a failure harmless. Of copies in one batch
    the one with the lowest ``page_id`` goes in. With ``delay``, equal copies
    that arrive within it (a text) or were fetched within it (a time span) are dropped before a batch is formed. ``found``
    holds the listing links (see ``load_batch``). Every ``compact_every`` batches the small files they leave
    are put together.
    """
    pages = read_page_stream(spark, pages_path, files_per_batch)
    if isinstance(delay, dt.timedelta):
        spark.conf.set(IDLE_BATCHES, "false")
        pages = pages_by_event_time(pages, delay)
    elif delay is not None:
        pages = distinct_pages(pages, delay)

    def load(batch: DataFrame, number: int) -> None:
        load_batch(batch, rules, store_path, found)
        if (number + 1) % compact_every == 0:
            store.compact(batch.sparkSession, store_path)

    return (
        pages.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
