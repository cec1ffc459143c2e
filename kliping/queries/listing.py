"""Grids, addresses and links of listings."""

from pyspark.sql import functions as F

from kliping.functions import urls
from kliping.operators import links
from kliping.plans import listings
from kliping.queries import sqltext as q
from kliping.queries.registry import days_as_text, query
from kliping.session import table

SPAN = """
    SELECT event_type, min(ts)::DATE AS lo, max(ts)::DATE AS hi FROM events GROUP BY event_type
"""
GRID = """
    SELECT event_type, (SELECT min(ts)::DATE FROM events) + n::INTEGER AS date
    FROM (SELECT DISTINCT event_type FROM events),
         range(0, (SELECT max(ts)::DATE - min(ts)::DATE FROM events)) t(n)
"""
# Each event type plays a site, its k values are the categories in their order.
SITES = """
    SELECT DISTINCT event_type AS site, CAST(json_extract(props, '$.k') AS INTEGER) AS cat_ord FROM events
"""
# The place of a site's highest value plays the part of the interrupted run.
STOPPED = """
    SELECT event_type AS site, ts::DATE AS date, CAST(json_extract(props, '$.k') AS INTEGER) AS cat_ord,
           user_id::INTEGER AS page
    FROM events WHERE event_type <> 'view'
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) = 1
"""


def _grid(spark, sf):
    events = table(spark, sf, "events")
    day = F.to_date("ts")
    kinds = events.select("event_type").distinct()
    low, high = events.agg(F.min(day)).scalar(), events.agg(F.max(day)).scalar()
    return listings.seed_grid(kinds, low, high)


@query(f"SELECT event_type, (lo + n::INTEGER)::VARCHAR AS date FROM ({SPAN}) s, range(0, hi - lo) t(n)")
def date_range(spark, sf):
    day = F.to_date("ts")
    spans = table(spark, sf, "events").groupBy("event_type").agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return days_as_text(listings.explode_dates(spans, F.col("lo"), F.col("hi")).select("event_type", "date"))


@query(f"SELECT event_type, date::VARCHAR AS date FROM ({GRID})")
def seed_grid(spark, sf):
    return days_as_text(_grid(spark, sf))


@query(f"""
    SELECT g.site, g.cat_ord, g.date::VARCHAR AS date,
           CASE WHEN g.date = s.date AND g.cat_ord = s.cat_ord THEN s.page ELSE 1 END AS first_page
    FROM (SELECT c.site, c.cat_ord, d.date FROM ({SITES}) c JOIN ({GRID}) d ON d.event_type = c.site) g
    LEFT JOIN ({STOPPED}) s ON s.site = g.site
    WHERE s.site IS NULL OR g.date > s.date OR (g.date = s.date AND g.cat_ord >= s.cat_ord)
""")
def resume_slice(spark, sf):
    events = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    day = F.to_date("ts")
    categories = events.select(F.col("event_type").alias("site"), k.alias("cat_ord")).distinct()
    grid = listings.seed_grid(categories, events.agg(F.min(day)).scalar(), events.agg(F.max(day)).scalar())
    place = F.struct(day.alias("date"), k.alias("cat_ord"), F.col("user_id").cast("int").alias("page"))
    highest = F.struct("value", -F.col("event_id"))
    state = (
        events.filter(F.col("event_type") != "view")
        .groupBy(F.col("event_type").alias("site"))
        .agg(F.max_by(place, highest).alias("stopped"))
        .select("site", "stopped.*")
    )
    return days_as_text(listings.pending(grid, state).select("site", "cat_ord", "date", "first_page"))


@query(f"""
    SELECT event_type, date::VARCHAR AS date, page,
           'https://' || event_type || '.example.com/indeks/' || page || '?date='
             || strftime(date, '%m/%d/%Y') || '&day=' || day(date) || '&offset=' || ((page - 1) * 15) AS listing_url
    FROM ({GRID}) g,
         (SELECT DISTINCT CAST(json_extract(props, '$.k') AS INTEGER) AS page, event_type AS t FROM events) p
    WHERE p.t = g.event_type AND p.page >= 1
""")
def listing_urls(spark, sf):
    events = table(spark, sf, "events")
    day = F.to_date("ts")
    pages = events.select("event_type", F.get_json_object("props", "$.k").cast("int").alias("page")).distinct()
    grid = listings.seed_grid(
        pages.filter(F.col("page") >= 1), events.agg(F.min(day)).scalar(), events.agg(F.max(day)).scalar()
    )
    template = F.lit("https://{cat}.example.com/indeks/{page}?date={MM}/{dd}/{yyyy}&day={d}&offset={offset}")
    url = listings.fill_template(template, F.col("event_type"), F.col("date"), F.col("page"), F.lit(15))
    return days_as_text(grid.select("event_type", "date", "page", url.alias("listing_url")))


@query("""
    SELECT o_orderkey, CAST((o_custkey - 1) * 15 AS BIGINT) AS offset_15,
           CAST((o_custkey - 1) * 30 AS BIGINT) AS offset_30, CAST((o_custkey - 1) * 10 AS BIGINT) AS offset_10
    FROM orders
""")
def page_offsets(spark, sf):
    page = F.col("o_custkey")
    return table(spark, sf, "orders").select(
        "o_orderkey", *[listings.page_offset(page, n).alias(f"offset_{n}") for n in (15, 30, 10)]
    )


@query(rf"""
    SELECT 'count' AS kind, o_custkey AS id, CAST(ceil(count(*) / 12.0) AS INTEGER) AS last_page
    FROM orders GROUP BY o_custkey
    UNION ALL
    SELECT 'tail', page_id, coalesce(try_cast(nullif(regexp_extract(url, '(\d+)\D*$', 1), '') AS INTEGER), 1) FROM pages
    UNION ALL
    SELECT 'offset', page_id,
           coalesce(try_cast(nullif(regexp_extract(url, '(\d+)\D*$', 1), '') AS INTEGER) // 15 + 1, 1)::INTEGER FROM pages
""")
def max_page(spark, sf):
    """Page totals from item counts, and last pages from link tails."""
    totals = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    pages = table(spark, sf, "pages")
    counted = totals.select(F.lit("count").alias("kind"), "id", F.col("n").cast("string").alias("value"), F.lit(12).alias("size"))
    tails = pages.select(F.lit("tail").alias("kind"), F.col("page_id").alias("id"), F.col("url").alias("value"), F.lit(1).alias("size"))
    offsets = pages.select(F.lit("offset").alias("kind"), F.col("page_id").alias("id"), F.col("url").alias("value"), F.lit(15).alias("size"))
    last = listings.last_page(F.col("kind"), F.col("value"), F.col("size"), F.lit(1))
    return counted.union(tails).union(offsets).select("kind", "id", last.alias("last_page"))


@query("""
    SELECT c_custkey, unnest(range(1, n_nationkey + 2))::INTEGER AS page
    FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def page_expand(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf, "nation").select("n_nationkey")
    both = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return listings.page_expand(both, F.lit(1), F.col("n_nationkey") + 1).select("c_custkey", "page")


NAV_LINKS = rf"""
    SELECT page_id, url, unnest(l) AS link, (generate_subscripts(l, 1) - 1)::INTEGER AS pos
    FROM (SELECT page_id, url,
                 regexp_extract_all({q.element('html', 'nav')},
                     '(?i)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']', 1) AS l FROM pages)
"""


@query(NAV_LINKS)
def listing_links(spark, sf):
    return links.page_links(table(spark, sf, "pages"))


@query(f"""
    SELECT page_id, pos, CASE WHEN regexp_matches(link, '^[a-zA-Z][a-zA-Z0-9+.-]*://') THEN link
                              ELSE {q.BASE} || link END AS link
    FROM ({NAV_LINKS})
""")
def absolute_links(spark, sf):
    found = links.page_links(table(spark, sf, "pages"))
    return links.absolute(found, "link", urls.base(F.col("url"))).select("page_id", "pos", "link")


@query(f"SELECT page_id, url, {q.KEY} AS url_key FROM pages")
def canonical_url(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url", links.canonical_url(F.col("url")).alias("url_key"))
