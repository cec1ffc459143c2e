"""From raw pages to the article table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kliping.functions import cleanup, dates, urls
from kliping.operators import dedupe, extract, filters, links
from kliping.session import durable


def article_table(pages: DataFrame) -> DataFrame:
    """Articles out of pages of plain markup, in built-in expressions only.

    Source is the host, category the first path segment and the number the
    last one. Pages are turned into (smaller) articles before copies of an
    address are dropped, so the one shuffle carries no markup.
    """
    html = F.col("html")
    body = cleanup.br_to_space(cleanup.drop_tags(cleanup.element(html, "article"), ["script", "style"]))
    path = urls.segments(F.col("url"))
    number = F.regexp_extract(F.try_element_at(path, F.lit(-1)), r"(\d+)", 1)
    tags = F.array_join(F.transform(cleanup.elements(cleanup.element(html, "nav"), "a"), cleanup.html_text), ",")
    no_date = F.lit(None).cast("timestamp")
    rows = pages.select(
        "page_id",
        urls.canonical(F.col("url")).alias("url_key"),
        dates.article_key([number], no_date, F.col("url")).alias("post_id"),
        F.lit("").alias("author"),
        no_date.alias("pubdate"),
        F.coalesce(F.get(path, 0), F.lit("")).alias("category"),
        F.lit("").alias("subcategory"),
        cleanup.unescape_common(cleanup.strip_control(cleanup.html_text(body))).alias("content"),
        F.lit(0).alias("comments"),
        F.lit("").alias("images"),
        cleanup.unescape_common(cleanup.html_text(cleanup.element(html, "h1"))).alias("title"),
        cleanup.unescape_common(tags).alias("tags"),
        "url",
        urls.host(F.col("url")).alias("source"),
    )
    return filters.project_article(dedupe.first_by_key(rows, "url_key", ["page_id"]))


def unseen_links(
    found: DataFrame, store: DataFrame, rules: DataFrame, by: Sequence[str], order: Sequence[str], accepted: Column | None = None,
    run_order: Sequence[str] | None = None,
) -> DataFrame:
    """Links to follow, by each site's habit.

    Sites listed newest first stop at the first link seen before, in the listing or, given the ``run_order`` in which
    the run comes to its links, in any of its listings. Of the others, and of sites that ``rules``, the listing table,
    does not know, every unseen link is taken.
    """
    marked = found.join(rules.select("site", "stops_at_seen"), "site", "left").select(*found.columns, "stops_at_seen")
    stops = F.coalesce("stops_at_seen", F.lit(False))
    stopping = dedupe.until_first_seen(marked.filter(stops), store, by, order, accepted=accepted, run_order=run_order)
    others = dedupe.new_links(marked.filter(~stops), store).select(*marked.columns)
    return stopping.unionByName(others).drop("stops_at_seen")


def fresh_fields(pages: DataFrame, rules: DataFrame, store: DataFrame) -> DataFrame:
    """Fields of the pages whose address is not stored yet.

    The cheap test comes first: stored addresses leave before the Python step
    that reads the markup.
    """
    fresh = dedupe.new_links(pages.withColumn("url_key", links.canonical_url(F.col("url"))), store)
    return extract.extract_fields(fresh, rules)


def harvest(pages: DataFrame, rules: DataFrame, store: DataFrame, row_id: str = "page_id") -> DataFrame:
    """Fields and outcome of every page whose address is not stored yet.

    ``pages`` needs ``site, url, html`` and a unique ``row_id``; the outcome
    frame still holds rejected rows with their reason. The fields go to the
    checkpoint folder, as ranking and marking would extract them twice.
    """
    fields = durable(fresh_fields(pages, rules, store))
    return dedupe.load_outcome(fields, store, row_id, [row_id])
