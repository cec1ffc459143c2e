"""Field extraction."""

from pyspark.sql import functions as F

from kliping.functions import cleanup, dates, markup, urls
from kliping.functions import nodes as N
from kliping.operators import extract, links
from kliping.plans import articles
from kliping.queries import sqltext as q
from kliping.queries.cleaning import decomposed
from kliping.queries.registry import query
from kliping.rules.listings import listing_rules
from kliping.rules.notation import at, ban, const, drop, every, having, need, node, url
from kliping.rules.sites import site_rules
from kliping.session import table

# A site of the given pages, written as rule rows like any other.
PLAIN_SITE = {
    "plain": {
        "fields": {
            "post_id": [url(r"/(\d+)")],
            "title": [node(at("h2")), node(at("article"), at("h1"))],
            "author": [node(at("article"), at("p"), at("b"))],
            "category": [const("Pages")],
            "subcategory": [node(having("html", "lang"), take="lang")],
            "tags": [node(at("nav"), every("a"))],
            "images": [node(at("nav"), at("a", pick=-1), take="href")],
        },
        "required": [need("body", at("article"))],
        "banned": [ban("title", "que ", "onth")],
        "body": [node(at("article"))],
        "drops": [drop("h1"), drop("p", phrase="nicht"), drop("p", phrase="with", child="b"), drop("script")],
    }
}
PLAIN_LISTING = {
    "plain": {
        "template": "", "items": [[at("nav"), every("li")]], "prefix": "https://listing.example",
        "label": [at("a")], "next": ("tail", [at("nav"), at("a", pick=-1)], "href"),
    }
}

ARTICLE = q.element("html", "article")
H1 = q.unescape(q.text(q.element("html", "h1")))
NAV = q.element("html", "nav")
NAV_TEXTS = f"list_transform({q.elements(NAV, 'a')}, lambda a: {q.unescape(q.text('a'))})"
NAV_HREFS = rf"""regexp_extract_all({NAV}, '(?i)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']', 1)"""
# Paragraphs are flat, so each runs from its start tag to the next one.
PIECES = f"string_split(regexp_replace({ARTICLE}, '</p>', '', 'g'), '<p>')[2:]"
KEPT = f"""list_filter({PIECES}, lambda p: NOT (contains(lower({q.text('p')}), 'nicht')
             OR contains(lower({q.text("regexp_extract(p, '(?s)<b>(.*)$', 1)")}), 'with')))"""
FIELDS_SQL = rf"""
    SELECT page_id, 'plain' AS site, coalesce(try_cast(nullif(regexp_extract(url, '/(\d+)', 1), '') AS BIGINT), 0) AS post_id,
           coalesce({q.unescape(q.text(f"regexp_extract({PIECES}[1], '(?s)<b>(.*)$', 1)"))}, '') AS author,
           NULL::TIMESTAMP AS pubdate, 'Pages' AS category, regexp_extract(html, '<html lang="([^"]*)"', 1) AS subcategory,
           {decomposed(q.control(q.unescape(q.text(f"array_to_string({KEPT}, '<p>')").replace(ARTICLE, q.br(ARTICLE)))))} AS content,
           0 AS comments, {NAV_HREFS}[-1] AS images, {H1} AS title, array_to_string({NAV_TEXTS}, ',') AS tags,
           url, 'plain' AS source,
           CASE WHEN contains(lower({H1}), 'que ') OR contains(lower({H1}), 'onth') THEN 'word_in_title' END AS reject_reason
    FROM pages
"""


def plain_pages(spark, sf):
    site = F.when(urls.host(F.col("url")).contains(".example."), "plain").alias("site")
    return table(spark, sf, "pages").select("page_id", site, "url", "html")


@query(FIELDS_SQL)
def extract_fields(spark, sf):
    return extract.extract_fields(plain_pages(spark, sf), site_rules(spark, PLAIN_SITE))


@query(f"""
    WITH fields AS ({FIELDS_SQL}), fresh AS (
        SELECT *, {q.KEY} AS url_key FROM fields
        WHERE {q.KEY} NOT IN (SELECT {q.KEY} FROM pages WHERE url LIKE 'http:%'))
    SELECT page_id, url_key, post_id, title, content,
           CASE WHEN reject_reason IS NOT NULL THEN 'rejected'
                WHEN row_number() OVER (PARTITION BY url_key, reject_reason IS NULL ORDER BY page_id) = 1 THEN 'inserted'
                ELSE 'duplicate' END AS outcome
    FROM fresh
""")
def harvest(spark, sf):
    """Unseen pages through extraction to their load outcome."""
    key = urls.canonical(F.col("url")).alias("url_key")
    stored = table(spark, sf, "pages").filter(F.col("url").startswith("http:")).select(key)
    rows = articles.harvest(plain_pages(spark, sf), site_rules(spark, PLAIN_SITE), stored)
    return rows.select("page_id", key, "post_id", "title", "content", "outcome")


@query(f"""
    SELECT page_id, unnest(range(0, len(h)))::INTEGER AS pos,
           unnest(list_transform(h, lambda u: CASE WHEN u LIKE 'http%' THEN u ELSE 'https://listing.example' || u END)) AS link,
           unnest(t) AS label
    FROM (SELECT page_id, {NAV_HREFS} AS h, {NAV_TEXTS} AS t FROM pages)
""")
def listing_items(spark, sf):
    listings = plain_pages(spark, sf).withColumn("page", F.lit(1))
    items = links.listing_links(listings, listing_rules(spark, PLAIN_LISTING))
    return items.select("page_id", "pos", "link", "label")


@query("SELECT page_id, regexp_extract(html, '(?i)<meta charset=\"([^\"]*)\"', 1) AS charset FROM pages")
def meta_charset(spark, sf):
    return table(spark, sf, "pages").select("page_id", markup.attribute(F.col("html"), "meta", "charset").alias("charset"))


@query(f"""
    SELECT page_id, {q.unescape(q.text(q.element('html', 'title')))} AS title, {H1} AS heading FROM pages
""")
def page_title(spark, sf):
    title, heading = (
        cleanup.unescape_common(cleanup.html_text(cleanup.element(F.col("html"), tag))) for tag in ("title", "h1")
    )
    return table(spark, sf, "pages").select("page_id", title.alias("title"), heading.alias("heading"))


@query("SELECT page_id, regexp_extract(html, '<html lang=\"([^\"]*)\"', 1) AS lang FROM pages")
def html_lang(spark, sf):
    return table(spark, sf, "pages").select("page_id", markup.attribute(F.col("html"), "html", "lang").alias("lang"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.none.name') AS missing FROM events")
def json_props(spark, sf):
    parsed = F.try_parse_json("props")
    return table(spark, sf, "events").select(
        "event_id", F.try_variant_get(parsed, "$.k", "int").alias("k"), F.try_variant_get(parsed, "$.none.name", "string").alias("missing")
    )


@query(f"""
    SELECT page_id, {decomposed(f"{H1} || ' 1'")} AS first, {decomposed(f"{H1} || ' 3'")} AS last,
           {decomposed(f"{H1} || ' 2'")} AS before_last,
           {decomposed(f"{H1} || CASE WHEN contains(html, '</html>') THEN ' 3' ELSE ' 1' END")} AS dated
    FROM pages
""")
def jsonld_pick(spark, sf):
    """Three JSON-LD blocks per page, made from its own heading."""
    heading = cleanup.unescape_common(cleanup.html_text(cleanup.element(F.col("html"), "h1")))
    date = F.when(F.col("html").contains("</html>"), F.lit("2018-07-27T15:18:00+00:00")).otherwise(F.lit(""))

    def block(n, *more):
        body = F.to_json(F.struct(F.concat(heading, F.lit(f" {n}")).alias("headline"), *more))
        return F.concat(F.lit('<script type="application/ld+json">\n'), body, F.lit("</script>"))

    pages = table(spark, sf, "pages").select("page_id", F.concat(block(1), block(2), block(3, date.alias("datePublished"))).alias("html"))
    blocks = F.transform(F.filter("nodes", lambda n: n["tag"] == "#json"), lambda n: n["text"])
    flat = N.flatten_pages(pages).withColumn("blocks", blocks)
    picked = [
        F.get_json_object(extract.jsonld(F.col("blocks"), pick), "$.headline").alias(pick)
        for pick in ("first", "last", "before_last", "dated")
    ]
    return flat.select("page_id", *picked)



@query("SELECT doc_id, lang AS headline, '2018-07-27' AS date, contains(text, '.') AS was_broken FROM documents")
def json_repair(spark, sf):
    """JSON whose body text holds bare quotes, made from the documents."""
    body = F.replace(cleanup.strip_control(F.col("text")), F.lit("."), F.lit('"'))
    text = F.concat(
        F.lit('{"headline": "'), F.col("lang"), F.lit('", "articleBody": "'), body, F.lit('", "datePublished": "2018-07-27"}')
    )
    fixed = extract.repair_json(text)
    return table(spark, sf, "documents").select(
        "doc_id", F.get_json_object(fixed, "$.headline").alias("headline"), F.get_json_object(fixed, "$.datePublished").alias("date"),
        F.try_parse_json(text).isNull().alias("was_broken"),
    )


@query(f"""
    SELECT page_id, {q.SEGMENTS}[1] AS category, {q.SEGMENTS}[-1] AS last_segment, {q.SEGMENTS}[9] AS missing,
           {NAV_TEXTS}[2] AS second_crumb, {NAV_TEXTS}[-2] AS crumb_before_last
    FROM pages
""")
def breadcrumb(spark, sf):
    path = urls.segments(F.col("url"))
    anchors = cleanup.elements(cleanup.element(F.col("html"), "nav"), "a")
    crumbs = F.transform(anchors, lambda a: cleanup.unescape_common(cleanup.html_text(a)))
    return table(spark, sf, "pages").select(
        "page_id", markup.breadcrumb(path, 1).alias("category"), markup.breadcrumb(path, -1).alias("last_segment"),
        markup.breadcrumb(path, 9).alias("missing"), markup.breadcrumb(crumbs, 2).alias("second_crumb"),
        markup.breadcrumb(crumbs, -2).alias("crumb_before_last"),
    )


@query(rf"""
    SELECT page_id, coalesce(nullif(regexp_extract({ARTICLE}, '(?is)<h2\b[^>]*>(.*?)</h2\s*>', 1), ''),
                             nullif(regexp_extract({H1}, '^[A-M].*'), ''), {q.unescape(q.text(q.element('html', 'title')))}, '') AS title
    FROM pages
""")
def fallback_title(spark, sf):
    html = F.col("html")
    heading = cleanup.unescape_common(cleanup.html_text(cleanup.element(html, "h1")))
    title = cleanup.unescape_common(cleanup.html_text(cleanup.element(html, "title")))
    chosen = markup.fallback(
        markup.meta_content(html, "og:title"), cleanup.element(html, "h2"), F.regexp_extract(heading, "^[A-M].*", 0), title
    )
    return table(spark, sf, "pages").select("page_id", chosen.alias("title"))


@query("""
    SELECT d.doc_id, coalesce(quality, 0) AS quality, coalesce(CAST(toxic AS VARCHAR), '') AS toxic
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
""")
def defaults(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return rows.select(
        "doc_id", F.coalesce("quality", F.lit(0)).alias("quality"), F.coalesce(F.col("toxic").cast("string"), F.lit("")).alias("toxic")
    )


@query(f"SELECT page_id, replace(array_to_string({NAV_TEXTS}, ','), '#', '') AS tags FROM pages")
def tag_list(spark, sf):
    anchors = cleanup.elements(cleanup.element(F.col("html"), "nav"), "a")
    texts = F.transform(anchors, lambda a: cleanup.unescape_common(cleanup.html_text(a)))
    return table(spark, sf, "pages").select("page_id", markup.tag_list(texts).alias("tags"))


@query("SELECT c_custkey, split_part(c_name, '#', 1) AS author, split_part(c_name, '#', 2) AS number FROM customer")
def split_byline(spark, sf):
    parts = dates.split_byline(F.col("c_name"), "#")
    return table(spark, sf, "customer").select(
        "c_custkey", F.try_element_at(parts, F.lit(1)).alias("author"), F.try_element_at(parts, F.lit(2)).alias("number")
    )


@query(r"SELECT page_id, regexp_extract(html, 'track\((\d+)\)', 1) AS tracked FROM pages")
def script_value(spark, sf):
    from kliping.sources.pages import script_value as value

    return table(spark, sf, "pages").select("page_id", value(F.col("html"), r"track\((\d+)\)").alias("tracked"))


@query(f"SELECT page_id, {q.unescape('html')} AS html FROM pages")
def unescape_common(spark, sf):
    return table(spark, sf, "pages").select("page_id", cleanup.unescape_common(F.col("html")).alias("html"))
