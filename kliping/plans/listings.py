"""Expected listings as tables: dates, categories, pages and their addresses.

A grid row says which listing should have arrived. Grids grow out of the
category table by generators, never by a join of all pairs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kliping.functions import nodes as N


def _as_date(value: Column | dt.date | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def explode_dates(df: DataFrame, start: Column | dt.date | str, end: Column | dt.date | str, name: str = "date") -> DataFrame:
    """One row per day of ``[start, end)``; an empty range gives no row.

    ``sequence`` counts down when its end lies before its start, hence the
    filter in front of it.
    """
    first, stop = _as_date(start), _as_date(end)
    return df.filter(first < stop).withColumn(name, F.explode(F.sequence(first, F.date_sub(stop, 1))))


def date_range(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    return explode_dates(spark.range(1).select(), start, end)


def seed_grid(categories: DataFrame, start: Column | dt.date | str, end: Column | dt.date | str) -> DataFrame:
    """Every category on every day of the half-open range."""
    return explode_dates(categories, start, end)


def pending(grid: DataFrame, run_state: DataFrame) -> DataFrame:
    """What is left of a grid after an interrupted run.

    ``run_state`` has one row per site: ``date``, ``cat_ord`` and ``page`` where
    the run stopped. Its first listing goes on at that page, later ones start at
    page 1, earlier ones are done. Sites without a state are wholly pending.
    """
    state = run_state.select(
        "site",
        F.struct("date", "cat_ord").alias("stopped_at"),
        F.col("page").alias("stopped_page"),
    )
    here = F.struct("date", "cat_ord")
    return (
        grid.join(state, "site", "left")
        .filter(F.col("stopped_at").isNull() | (here >= F.col("stopped_at")))
        .withColumn("first_page", F.when(here == F.col("stopped_at"), F.col("stopped_page")).otherwise(F.lit(1)))
        .drop("stopped_at", "stopped_page")
    )


def page_offset(page: Column, page_size: Column | int) -> Column:
    return (page - 1) * page_size


def fill_template(
    template: Column, category: Column, date: Column, page: Column, page_size: Column, subcategory: Column | None = None
) -> Column:
    """Fill a listing address.

    Places: ``{cat} {sub} {page} {offset}`` and ``{yyyy} {MM} {dd}`` with,
    ``{M} {d}`` without leading zero.
    """
    places = {
        "{cat}": category,
        "{sub}": F.lit("") if subcategory is None else subcategory,
        "{page}": page.cast("string"),
        "{offset}": page_offset(page, page_size).cast("string"),
        "{yyyy}": F.year(date).cast("string"),
        "{MM}": F.lpad(F.month(date).cast("string"), 2, "0"),
        "{dd}": F.lpad(F.day(date).cast("string"), 2, "0"),
        "{M}": F.month(date).cast("string"),
        "{d}": F.day(date).cast("string"),
    }
    for place, value in places.items():
        template = F.replace(template, F.lit(place), F.coalesce(value, F.lit("")))
    return template


def listing_urls(grid: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``listing_url`` to a grid of ``site, category, date, page`` (and
    ``subcategory`` where a site needs it).

    ``rules`` is the listing table of ``kliping.rules``, one literal row per site. Rows of sites it does not know get
    no address.
    """
    used = ["template", "first_template", "section", "section_template", "page_size"]
    template = (
        F.when(F.col("category") == F.col("section"), F.col("section_template"))
        .when(F.col("page") == 1, F.coalesce("first_template", "template"))
        .otherwise(F.col("template"))
    )
    subcategory = F.col("subcategory") if "subcategory" in grid.columns else None
    url = fill_template(template, F.col("category"), F.col("date"), F.col("page"), F.col("page_size"), subcategory)
    return (
        grid.join(rules.select("site", *used), "site", "left").withColumn("listing_url", F.when(F.col("template").isNotNull(), url)).drop(*used)
    )


def page_expand(df: DataFrame, first: Column, last: Column, name: str = "page") -> DataFrame:
    """One row per page from ``first`` to ``last``, both included."""
    return df.filter(first <= last).withColumn(name, F.explode(F.sequence(first, last)))


def last_page(kind: Column, value: Column, page_size: Column, page: Column) -> Column:
    """Page number of the last listing page, from the value a rule has found.

    Kinds: ``number`` (link text or data attribute), ``tail`` (digits that end a
    link), ``count`` (items in all), ``offset`` (digits that end a link, in
    items), ``last_word`` ("page x of N"), ``more`` (a next link exists). Without
    a value the page read is the last one.
    """
    tail = F.regexp_extract(value, r"(\d+)\D*$", 1).try_cast("int")
    return F.coalesce(
        F.when(kind == "count", F.ceil(tail / page_size).cast("int"))
        .when(kind == "offset", (F.floor(tail / page_size) + 1).cast("int"))
        .when(kind == "more", F.when(value.isNotNull(), page + 1))
        .otherwise(tail),
        page,
    )


def max_page(listings: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``last_page`` to listing pages (``site, page, html``) by each site's rule; NULL for sites without one."""
    carried = [c for c in listings.columns if c != "html"]
    used = ["page_size", "next_kind", "next_steps", "next_take"]
    flat = N.flatten_pages(listings, places=True).join(rules.select("site", *used), "site", "left")
    nodes = F.col("nodes")
    places = F.col("places")
    hit = F.get(N.select(nodes, N.root(nodes), F.col("next_steps"), places), 0)
    value = N.let(hit, lambda n: F.when(n.isNotNull(), N.value_of(nodes, n, F.col("next_take"), places)))
    last = last_page(F.col("next_kind"), value, F.col("page_size"), F.col("page"))
    return flat.select(*carried, F.when(F.col("next_kind").isNotNull(), last).alias("last_page"))


def readable_category(slug: Column) -> Column:
    """A category name out of its address part."""
    return F.replace(slug, F.lit("-"), F.lit(""))
