"""Filters, reject reasons and projections."""

from pyspark.sql import functions as F

from kliping.functions import cleanup, urls
from kliping.operators import filters, links
from kliping.queries import sqltext as q
from kliping.queries.registry import query
from kliping.session import table


@query("SELECT event_id, event_type FROM events WHERE NOT regexp_matches(lower(event_type), 'view|sign')")
def filter_badge(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    return filters.drop_badges(events, "event_type", ["view", "sign"])


@query("SELECT page_id, url FROM pages WHERE NOT list_has_any(string_split(url, '/'), ['fr', 'de', 'video'])")
def filter_url_segment(spark, sf):
    return links.filter_segments(table(spark, sf, "pages").select("page_id", "url"), "url", ["fr", "de", "video"])


@query("""
    SELECT doc_id, lang, source FROM documents
    WHERE NOT (contains(lower(text), 'reed') OR contains(lower(text), 'nicht') OR contains(lower(text), 'avec'))
""")
def filter_keyword(spark, sf):
    documents = table(spark, sf, "documents")
    return filters.drop_mentions(documents, ["text"], ["reed", "nicht", "AVEC"]).select("doc_id", "lang", "source")


TITLE = q.unescape(q.text(q.element("html", "title")))


@query(f"""
    SELECT page_id, title FROM (SELECT page_id, {TITLE} AS title FROM pages)
    WHERE NOT (contains(lower(title), 'the ') OR contains(lower(title), 'que'))
""")
def filter_title(spark, sf):
    title = cleanup.unescape_common(cleanup.html_text(cleanup.element(F.col("html"), "title")))
    titled = table(spark, sf, "pages").select("page_id", title.alias("title"))
    return filters.drop_mentions(titled, ["title"], ["the ", "que"])


@query("""
    SELECT doc_id, source, lang FROM documents
    WHERE NOT (contains(lower(source), '7') OR contains(lower(lang), '7') OR contains(lower(source), 'es')
               OR contains(lower(lang), 'es'))
""")
def filter_tag(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "source", "lang")
    return filters.drop_mentions(documents, ["source", "lang"], ["7", "es"])


@query(f"""
    SELECT page_id, CASE WHEN NOT contains(html, '<nav') THEN 'breadcrumb'
                         WHEN {q.element('html', 'article')} = '' THEN 'body'
                         WHEN NOT contains({q.element('html', 'h1')}, ' ') THEN 'title'
                         WHEN NOT contains(html, '</html>') THEN 'unfinished' END AS reject_reason
    FROM pages
""")
def reject_reason(spark, sf):
    html = F.col("html")
    reason = filters.reject_reason(
        {
            "breadcrumb": html.contains("<nav"),
            "body": cleanup.element(html, "article") != "",
            "title": cleanup.element(html, "h1").contains(" "),
            "unfinished": html.contains("</html>"),
        }
    )
    return table(spark, sf, "pages").select("page_id", reason.alias("reject_reason"))


@query("SELECT event_id, event_type, ts FROM events WHERE ts::DATE = DATE '2024-01-15'")
def filter_date(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return filters.on_date(events, "ts", F.lit("2024-01-15").cast("date"))


@query(f"""
    SELECT page_id AS post_id, '' AS author, NULL::TIMESTAMP AS pubdate, 'Properti' AS category, '' AS subcategory,
           '' AS content, 0 AS comments, '' AS images, {q.element('html', 'title')} AS title, '' AS tags, url,
           {q.HOST} AS source
    FROM pages
""")
def project_article(spark, sf):
    rows = table(spark, sf, "pages").select(
        F.col("page_id").alias("post_id"), cleanup.element(F.col("html"), "title").alias("title"), "url",
        urls.host(F.col("url")).alias("source"), F.lit("Properti").alias("category"),
    )
    return filters.project_article(rows)


@query("""
    SELECT c_custkey, n_name, coalesce(r_name, 'Komunitas') AS label
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT * FROM region WHERE r_name < 'B' OR r_name > 'D') ON n_regionkey = r_regionkey
""")
def code_label(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    known = region.filter((F.col("r_name") < "B") | (F.col("r_name") > "D"))
    labelled = filters.code_label(nation, "n_regionkey", known, "r_regionkey", "r_name", "Komunitas")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return customer.join(labelled, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "label")
