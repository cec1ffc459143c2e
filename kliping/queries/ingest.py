"""Sources, sinks and run state."""

from pyspark.sql import functions as F

from kliping.operators import links
from kliping.functions import cleanup
from kliping.plans import articles
from kliping.queries import sqltext as q
from kliping.queries.registry import query
from kliping.sources import pages as sources
from kliping.sources import store
from kliping.session import scratch_path, table

CONTENT = q.unescape(q.control(q.text(q.br(q.drop(q.element("html", "article"), ["script", "style"])))))
NAV_TEXTS = f"list_transform({q.elements(q.element('html', 'nav'), 'a')}, lambda a: {q.text('a')})"


@query(rf"""
    SELECT coalesce(try_cast(nullif(regexp_extract({q.SEGMENTS}[-1], '(\d+)', 1), '') AS BIGINT), 3661 + length(url)) AS post_id,
           '' AS author, NULL::TIMESTAMP AS pubdate, coalesce({q.SEGMENTS}[1], '') AS category, '' AS subcategory,
           {CONTENT} AS content, 0 AS comments, '' AS images, {q.unescape(q.text(q.element('html', 'h1')))} AS title,
           {q.unescape(f"array_to_string({NAV_TEXTS}, ',')")} AS tags, url, {q.HOST} AS source
    FROM pages QUALIFY row_number() OVER (PARTITION BY {q.KEY} ORDER BY page_id) = 1
""")
def article_table(spark, sf):
    return articles.article_table(table(spark, sf, "pages"))


@query("SELECT page_id, url, html FROM pages")
def scan_pages(spark, sf):
    return sources.read_pages(spark, f"{sf}/pages.parquet")


@query("""
    SELECT event_id, json_extract_string(props, '$.k') AS k FROM events
    WHERE json_extract_string(props, '$.k') <> ''
""")
def json_envelope(spark, sf):
    return sources.unwrap_envelope(table(spark, sf, "events").select("event_id", "props"), "props", "k").select("event_id", "k")


@query(rf"""
    SELECT page_id, unnest(l[2:]) AS link, unnest(range(0, greatest(len(l) - 1, 0)))::INTEGER AS pos
    FROM (SELECT page_id, regexp_extract_all({q.element('html', 'nav')},
                 '(?i)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']', 1) AS l FROM pages)
""")
def state_links(spark, sf):
    """Page-state JSON built from each page's own links, then read back."""
    listed = F.transform(links.hrefs(cleanup.element(F.col("html"), "nav")), lambda u: F.struct(u.alias("articleUrl")))
    state = F.to_json(F.struct(F.array(F.struct(listed.alias("listarticle"))).alias("data")))
    script = F.concat(F.lit("<script>window.__NUXT__="), state, F.lit(";</script>"))
    pages = table(spark, sf, "pages").select("page_id", script.alias("html"))
    return sources.state_links(pages, "html").select("page_id", "link", "pos")


@query("SELECT doc_id, source, lang FROM documents WHERE source = 'src3' AND text LIKE '%the%'")
def scan_store(spark, sf):
    documents = table(spark, sf, "documents")
    wanted = (F.col("source") == "src3") & F.col("text").contains("the")
    return documents.filter(wanted).select("doc_id", "source", "lang")


@query("SELECT row_number() OVER (ORDER BY doc_id) - 1 AS _index, doc_id, text, lang, source FROM documents")
def csv_roundtrip(spark, sf):
    """Write an indexed dump of the documents and read it back."""
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    path = scratch_path(spark, "dump")
    store.write_dump(documents, path, "doc_id")
    return store.read_dump(spark, path, "_index BIGINT, doc_id BIGINT, text STRING, lang STRING, source STRING")


@query("""
    SELECT event_type AS site, user_id AS category, max(ts) AS written_at,
           arg_max(CAST(json_extract(props, '$.k') AS INTEGER), (ts, event_id)) AS page
    FROM events GROUP BY ALL
""")
def run_state_latest(spark, sf):
    states = table(spark, sf, "events").select(
        F.col("event_type").alias("site"), F.col("user_id").alias("category"), F.col("ts").alias("written_at"),
        "event_id", F.get_json_object("props", "$.k").cast("int").alias("page"),
    )
    return store.latest_run_state(states).select("site", "category", "written_at", "page")


@query("""
    SELECT doc_id, doc_id AS post_id, lang AS category, source, 'http://x/' || doc_id AS url, n_chars::INTEGER AS comments,
           text AS content, 'i' || doc_id AS images
    FROM documents
""")
def dump_rescue(spark, sf):
    """Records in dictionary text made from the documents, then rescued."""
    escaped = F.replace(F.col("text"), F.lit("\\"), F.lit("\\\\"))
    for plain, code in (("'", "\\'"), ("\n", "\\n"), ("\t", "\\t"), ("\r", "\\r")):
        escaped = F.replace(escaped, F.lit(plain), F.lit(code))
    cell = F.concat(
        F.lit("{'id': "), F.col("doc_id"), F.lit(", 'category': '"), F.col("lang"), F.lit("', 'source': '"), F.col("source"),
        F.lit("', 'url': 'http://x/"), F.col("doc_id"), F.lit("', 'comments': "), F.col("n_chars"),
        F.lit(", 'image': 'i"), F.col("doc_id"), F.lit("', 'content': '"), escaped, F.lit("'}"),
    )
    rescued, _ = store.rescue_dump(table(spark, sf, "documents").select("doc_id", cell.alias("cell")), "cell")
    return rescued.select("doc_id", "post_id", "category", "source", "url", "comments", "content", "images")
