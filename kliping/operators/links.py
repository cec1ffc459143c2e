"""Links of listing pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kliping.functions import cleanup, dates, urls
from kliping.functions import nodes as N
from kliping.functions.nodes import STEP, let
from kliping.sources import pages as sources

LISTING_RULES = T.StructType(
    [
        T.StructField("site", T.StringType()),
        T.StructField("template", T.StringType()),
        T.StructField("first_template", T.StringType()),
        T.StructField("section", T.StringType()),
        T.StructField("section_template", T.StringType()),
        T.StructField("page_size", T.IntegerType()),
        T.StructField("prefix", T.StringType()),
        # html, or JSON: an envelope around markup, or the page state in a script.
        T.StructField("form", T.StringType()),
        T.StructField("items", T.ArrayType(T.ArrayType(STEP))),
        T.StructField("link", T.ArrayType(STEP)),
        T.StructField("badge", T.ArrayType(STEP)),
        T.StructField("label", T.ArrayType(STEP)),
        T.StructField("needs_label", T.BooleanType()),
        # Where an item shows its day; items of other days than the listing's are left out.
        T.StructField("date", T.ArrayType(STEP)),
        T.StructField("stops_at_seen", T.BooleanType()),
        T.StructField("next_kind", T.StringType()),
        T.StructField("next_steps", T.ArrayType(STEP)),
        T.StructField("next_take", T.StringType()),
    ]
)

HREF = r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""


CARRIED = ["category", "subcategory"]


def hrefs(html: Column) -> Column:
    """Targets of all anchors, in document order."""
    return F.regexp_extract_all(html, F.lit(HREF), F.lit(1))


def page_links(pages: DataFrame, scope: str = "nav") -> DataFrame:
    """Anchors inside the first element of one tag: ``page_id, url, pos, link``.

    The column form for listings whose items need no rules; listings with
    per-site item rules go through ``listing_links``.
    """
    return pages.select(
        "page_id", "url", F.posexplode(hrefs(cleanup.element(F.col("html"), scope))).alias("pos", "link")
    )


def absolute(df: DataFrame, link: str, prefix: Column) -> DataFrame:
    return df.withColumn(link, urls.absolute(F.col(link), prefix))


def canonical_url(url: Column) -> Column:
    return urls.canonical(url)


def pages_with_links(pages: DataFrame, found: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Pages with the category and subcategory of the listing link that led to them.

    ``found`` has ``link`` and some of ``CARRIED``. Of several links to an
    address the first one counts, category and subcategory together: the first
    by ``order``, or else the smallest pair. Links without any category come
    last. Pages no link leads to keep what they have, or NULL.
    """
    have = [c for c in CARRIED if c in found.columns]
    pair = F.struct(*[F.col(c).alias(f"_{c}") for c in have])
    bare = F.coalesce(*have).isNull()
    rank = [F.col(c) for c in order] if order else [x for c in have for x in (F.col(c).isNull(), F.col(c))]
    first = F.min_by(pair, F.struct(bare, *rank)).alias("_pair")
    of = found.groupBy(urls.canonical(F.col("link")).alias("_key")).agg(first).select("_key", "_pair.*")
    both = pages.join(of, urls.canonical(pages["url"]) == F.col("_key"), "left")
    own = [c for c in have if c in pages.columns]
    known = F.coalesce(*[F.col(f"_{c}") for c in have]).isNotNull()
    kept = [F.when(known, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in own else F.col(c) for c in pages.columns]
    return both.select(*kept, *[F.col(f"_{c}").alias(c) for c in have if c not in own])


def filter_segments(df: DataFrame, url: str, words: Sequence[str]) -> DataFrame:
    """Drop rows whose address has one of the words as a whole path segment."""
    return df.filter(~F.coalesce(urls.has_segment(F.col(url), list(words)), F.lit(False)))


def listing_links(listings: DataFrame, rules: DataFrame) -> DataFrame:
    """Links of listing pages: ``pos, link, badge, label`` and a ``reject_reason`` beside the input.

    ``listings`` needs ``site, html``. A page of a site without rules gives one row, without a link and with the
    reason ``no_rules``. Where a site's items show their day and ``listings`` has the
    ``date`` it was asked for, only items of that day count. The link of an item is its first anchor
    with a target; items without one, and without the label a site asks for,
    give no row. Listings that arrive as JSON are read by the ``form`` of their
    site: markup in an envelope is unwrapped, links in a page state are taken
    from there.
    """
    known = listings.join(rules.select("site", "form", "prefix"), "site", "left")
    forms = known.filter("form is not null")
    carried = [c for c in listings.columns if c != "html"]
    state = sources.state_links(forms.filter("form = 'state'"), "html")
    nothing = F.lit(None).cast("string")
    state = state.select(
        *carried, "pos", urls.absolute(F.col("link"), F.coalesce("prefix", F.lit(""))).alias("link"),
        nothing.alias("badge"), nothing.alias("label"),
    )
    lost = known.filter("form is null").select(
        *carried, F.lit(None).cast("int").alias("pos"), *[nothing.alias(c) for c in ("link", "badge", "label")], F.lit("no_rules").alias("reject_reason")
    )
    inner = F.when(F.col("form") == "envelope", sources.envelope(F.col("html"))).otherwise(F.col("html"))
    marked = forms.filter("form <> 'state'").withColumn("html", inner).select(*listings.columns)
    return _items(marked, rules).unionByName(state).withColumn("reject_reason", nothing).unionByName(lost)


def _items(listings: DataFrame, rules: DataFrame) -> DataFrame:
    """Links of listings whose items are elements of markup."""
    carried = [c for c in listings.columns if c != "html"]
    used = ["prefix", "items", "link", "badge", "label", "needs_label", F.col("date").alias("_day")]
    flat = N.flatten_pages(listings, places=True).join(rules.select("site", *used), "site")
    nodes, places = F.col("nodes"), F.col("places")
    chains = F.transform("items", lambda steps: N.select(nodes, N.root(nodes), steps, places))
    items = F.get(F.filter(chains, lambda found: F.size(found) > 0), 0)

    def first_text(item: Column, steps: Column) -> Column:
        hit = F.get(N.select(nodes, F.array(item), steps, places), 0)
        return F.when(steps.isNotNull(), let(hit, lambda n: F.when(n.isNotNull(), N.text_of(nodes, n, places))))

    def on_day(item: Column) -> Column:
        """Whether the item's day, in front of its time, is the listing's; undated items are no articles there."""
        if "date" not in carried:
            return F.lit(True)
        day = F.to_date(dates.parse_local_dates(F.btrim(F.get(F.split(first_text(item, F.col("_day")), r"\|"), 0))))
        return F.col("_day").isNull() | F.coalesce(day == F.col("date").cast("date"), F.lit(False))

    def read(item: Column, place: Column) -> Column:
        anchors = F.when(F.size("link") == 0, F.array(item)).otherwise(N.select(nodes, F.array(item), F.col("link"), places))
        targets = F.transform(anchors, lambda n: F.try_element_at(n["attrs"], F.lit("href")))
        return F.struct(
            place.alias("pos"),
            F.get(F.array_compact(targets), 0).alias("target"),
            first_text(item, F.col("badge")).alias("badge"),
            first_text(item, F.col("label")).alias("label"),
            on_day(item).alias("on_day"),
        )

    # Items are read inside their page, so only small values are exploded.
    wanted = F.filter(
        F.transform(items, read),
        lambda x: x["on_day"] & x["target"].isNotNull() & (~F.col("needs_label") | x["label"].isNotNull()),
    )
    found = flat.select(*carried, "prefix", F.explode(wanted).alias("item"))
    return found.select(
        *carried,
        "item.pos",
        urls.absolute(F.col("item.target"), F.coalesce("prefix", F.lit(""))).alias("link"),
        "item.badge",
        "item.label",
    )
