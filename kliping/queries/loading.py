"""What is new, what is a copy, what was loaded.

Pages whose address starts with ``http:`` play the stored articles; every page
is an incoming link.
"""

from pyspark.sql import functions as F

from kliping.functions import cleanup, urls
from kliping.operators import dedupe, filters, links
from kliping.queries import sqltext as q
from kliping.queries.registry import query
from kliping.schema import ARTICLE
from kliping.session import scratch_path, table
from kliping.sources import store

STORED = f"SELECT regexp_replace({q.KEY}, '^https?:', '') AS k FROM pages WHERE url LIKE 'http:%'"
COMPLETE = "html LIKE '%</html>%'"


def _key():
    return F.regexp_replace(urls.canonical(F.col("url")), "^https?:", "")


def _links(spark, sf, *more):
    return table(spark, sf, "pages").select("page_id", "url", _key().alias("url_key"), *more)


def _store(spark, sf):
    return table(spark, sf, "pages").filter(F.col("url").startswith("http:")).select(_key().alias("url_key"))


@query(f"""
    SELECT page_id, url, regexp_replace({q.KEY}, '^https?:', '') AS url_key FROM pages
    WHERE regexp_replace({q.KEY}, '^https?:', '') NOT IN ({STORED})
""")
def new_links(spark, sf):
    return dedupe.new_links(_links(spark, sf), _store(spark, sf))


@query(f"""
    SELECT page_id, url, regexp_replace({q.KEY}, '^https?:', '') AS url_key FROM pages
    WHERE regexp_replace({q.KEY}, '^https?:', '') IN ({STORED})
""")
def seen_links(spark, sf):
    return dedupe.seen_links(_links(spark, sf), _store(spark, sf))


@query("""
    SELECT page_id, url AS url_key FROM pages p
    WHERE NOT EXISTS (SELECT 1 FROM pages s WHERE s.url LIKE 'http:%' AND replace(s.url, '_', '-') LIKE p.url)
""")
def new_links_like(spark, sf):
    pages = table(spark, sf, "pages")
    incoming = pages.select("page_id", F.col("url").alias("url_key"))
    stored = pages.filter(F.col("url").startswith("http:")).select(F.translate("url", "_", "-").alias("url_key"))
    return dedupe.new_links(incoming, stored, mode="like")


@query(f"""
    SELECT regexp_replace({q.KEY}, '^https?:', '') AS url_key, count(*) AS n FROM pages GROUP BY 1
""")
def url_counts(spark, sf):
    return dedupe.url_counts(_links(spark, sf))


@query("""
    SELECT doc_id, text, lang, source FROM documents
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1
""")
def first_by_url(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return dedupe.first_by_key(documents, "text", ["doc_id"])


@query(f"""
    WITH RECURSIVE links AS (
        SELECT row_number() OVER (ORDER BY page_id) AS n, page_id, {q.HOST} AS site, regexp_replace({q.KEY}, '^https?:', '') AS url_key,
               {COMPLETE} AS ok, regexp_replace({q.KEY}, '^https?:', '') IN
                   (SELECT regexp_replace({q.KEY}, '^https?:', '') FROM pages WHERE url LIKE 'http:%.html%') AS stored FROM pages),
    run AS (
        SELECT 0::BIGINT AS n, NULL::BIGINT AS page_id, NULL::VARCHAR AS site, NULL::VARCHAR AS url_key, FALSE AS kept,
               []::VARCHAR[] AS closed, []::VARCHAR[] AS taken
        UNION ALL
        SELECT n, page_id, site, url_key, NOT shut AND NOT seen, CASE WHEN seen AND NOT shut THEN list_append(closed, site) ELSE closed END,
               CASE WHEN NOT shut AND NOT seen AND ok THEN list_append(taken, url_key) ELSE taken END
        FROM (SELECT l.*, r.closed, r.taken, list_contains(r.closed, l.site) AS shut, l.stored OR list_contains(r.taken, l.url_key) AS seen
              FROM run r JOIN links l ON l.n = r.n + 1))
    SELECT page_id, site, url_key FROM run WHERE kept
""")
def until_first_seen(spark, sf):
    pages = table(spark, sf, "pages")
    found = pages.select(
        "page_id", urls.host(F.col("url")).alias("site"), _key().alias("url_key"),
        F.col("html").contains("</html>").alias("ok"),
    )
    stored = pages.filter(F.col("url").like("http:%.html%")).select(_key().alias("url_key"))
    kept = dedupe.until_first_seen(found, stored, ["site"], ["page_id"], accepted=F.col("ok"), run_order=["page_id"])
    return kept.select("page_id", "site", "url_key")


@query(f"""
    WITH batch AS (SELECT page_id, regexp_replace({q.KEY}, '^https?:', '') AS url_key, {COMPLETE} AS ok FROM pages),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY url_key, ok ORDER BY page_id) AS r FROM batch)
    SELECT page_id, url_key,
           CASE WHEN NOT ok THEN 'rejected'
                WHEN r > 1 OR url_key IN (SELECT regexp_replace({q.KEY}, '^https?:', '') FROM pages WHERE url LIKE 'http:%.html%')
                THEN 'duplicate' ELSE 'inserted' END AS outcome
    FROM ranked
""")
def load_outcome(spark, sf):
    pages = table(spark, sf, "pages")
    reason = filters.reject_reason({"unfinished": F.col("html").contains("</html>")})
    batch = _links(spark, sf, reason.alias("reject_reason"))
    stored = pages.filter(F.col("url").like("http:%.html%")).select(_key().alias("url_key"))
    return dedupe.load_outcome(batch, stored, "page_id", ["page_id"]).select("page_id", "url_key", "outcome")


@query(f"""
    WITH pages_ AS (SELECT page_id, regexp_replace({q.KEY}, '^https?:', '') AS url_key, {q.SEGMENTS} AS path, url FROM pages),
    found AS (
        SELECT url_key, arg_min({{'c': path[1], 's': path[2]}}, (path[1] IS NULL AND path[2] IS NULL, page_id)) AS pair
        FROM pages_ WHERE url LIKE 'http:%' GROUP BY 1)
    SELECT p.page_id, p.url_key AS url, f.pair.c AS category, f.pair.s AS subcategory FROM pages_ p LEFT JOIN found f ON f.url_key = p.url_key
""")
def pages_with_links(spark, sf):
    """Listing links (those of plain ``http``) hand their categories to the pages they lead to."""
    pages = table(spark, sf, "pages")
    path = urls.segments(F.col("url"))
    found = pages.filter(F.col("url").startswith("http:")).select(
        _key().alias("link"), F.get(path, 0).alias("category"), F.get(path, 1).alias("subcategory"), F.col("page_id").alias("seen_at")
    )
    return links.pages_with_links(pages.select("page_id", _key().alias("url")), found, order=["seen_at"])


@query(f"""
    SELECT page_id, url_key, title FROM (
        SELECT page_id, regexp_replace({q.KEY}, '^https?:', '') AS url_key, {q.element('html', 'h1')} AS title FROM pages)
    WHERE url_key NOT IN ({STORED})
    QUALIFY row_number() OVER (PARTITION BY url_key ORDER BY page_id) = 1
""")
def insert_if_absent(spark, sf):
    """The rows an insert adds to a store that holds the pages of plain ``http``, read back from it."""
    title = cleanup.element(F.col("html"), "h1")
    pages = table(spark, sf, "pages").select(
        "page_id", F.col("page_id").alias("post_id"), _key().alias("url"), title.alias("title"), urls.host(F.col("url")).alias("source"),
        F.col("url").startswith("http:").alias("plain"),
    )
    blank = {f.name: F.lit(None).cast(f.dataType) for f in ARTICLE.fields if f.name not in pages.columns}
    articles = pages.withColumns(blank)
    path = scratch_path(spark, "store")
    before = articles.filter("plain").withColumn("post_id", F.lit(-1).cast("long"))
    store.append(store.with_keys(before).select(*store.STORED.fieldNames()), path)
    store.insert_if_absent(articles.drop("plain"), path, "page_id")
    return store.read_store(spark, path, F.col("post_id") >= 0).select(F.col("post_id").alias("page_id"), "url_key", "title")


@query(f"""
    SELECT {q.HOST} AS source, page_id AS post_id, {q.element('html', 'title')} AS title, url FROM pages WHERE url LIKE 'http:%'
    UNION ALL
    SELECT {q.HOST}, page_id, {q.element('html', 'title')}, url FROM pages WHERE url NOT LIKE 'http:%' OR url IS NULL
    UNION ALL
    SELECT source, doc_id, lang, 'doc:' || doc_id FROM documents
""")
def union_sites(spark, sf):
    """Results of several sites in one article table."""
    pages = table(spark, sf, "pages").select(
        urls.host(F.col("url")).alias("source"), F.col("page_id").alias("post_id"),
        cleanup.element(F.col("html"), "title").alias("title"), "url",
    )
    documents = table(spark, sf, "documents").select(
        F.concat(F.lit("doc:"), F.col("doc_id")).alias("url"), "source", F.col("doc_id").alias("post_id"), F.col("lang").alias("title")
    )
    plain = pages.filter(F.col("url").startswith("http:"))
    secure = pages.filter(~F.col("url").startswith("http:") | F.col("url").isNull())
    return plain.unionByName(secure).unionByName(documents)
