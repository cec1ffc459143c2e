"""Content cleanup."""

import unicodedata

from pyspark.sql import functions as F

from kliping.functions import cleanup
from kliping.queries import sqltext as q
from kliping.queries.registry import query
from kliping.session import table

ARTICLE = q.element("html", "article")
PARAGRAPHS = f"list_transform({q.elements(ARTICLE, 'p')}, lambda p: {q.text(q.br('p'))})"


def decomposed(sql: str) -> str:
    """NFKD of the Latin-1 letters, which are all the tables hold beyond ASCII."""
    for code in range(0xC0, 0x100):
        parts = unicodedata.normalize("NFKD", chr(code))
        if len(parts) > 1:
            sql = f"replace({sql}, chr({code}), {' || '.join(f'chr({ord(c)})' for c in parts)})"
    return sql


def _paragraphs():
    return F.transform(
        cleanup.elements(cleanup.element(F.col("html"), "article"), "p"),
        lambda p: cleanup.html_text(cleanup.br_to_space(p)),
    )


@query(f"SELECT page_id, {q.drop('html', ['script', 'style'])} AS html FROM pages")
def drop_tags(spark, sf):
    html = cleanup.drop_tags(F.col("html"), ["script", "style"])
    return table(spark, sf, "pages").select("page_id", html.alias("html"))


@query(r"""
    SELECT page_id, regexp_replace(html, '(?is)<div\b[^>]*class="ad"[^>]*>.*?</div\s*>', '', 'g') AS html FROM pages
""")
def drop_ads(spark, sf):
    html = cleanup.drop_elements(F.col("html"), "div", "class", "ad")
    return table(spark, sf, "pages").select("page_id", html.alias("html"))


@query(f"""
    SELECT page_id, array_to_string(list_filter({PARAGRAPHS},
               lambda p: NOT (contains(lower(p), 'nicht') OR contains(lower(p), 'with'))), '|') AS paragraphs
    FROM pages
""")
def drop_phrases(spark, sf):
    kept = cleanup.drop_phrases(_paragraphs(), ["Nicht", "with"])
    return table(spark, sf, "pages").select("page_id", F.array_join(kept, "|").alias("paragraphs"))


@query("SELECT page_id, split_part(html, '<footer>', 1) AS html FROM pages")
def cut_after_marker(spark, sf):
    return table(spark, sf, "pages").select("page_id", cleanup.cut_after(F.col("html"), "<footer>").alias("html"))


@query("""
    SELECT doc_id, array_to_string(CASE WHEN contains(lower(text), ' the ') THEN l[1:greatest(len(l) - 7, 0)] ELSE l END, '|') AS lines
    FROM (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents)
""")
def drop_tail(spark, sf):
    lines = cleanup.drop_tail(F.split("text", "\n"), 7, F.col("text"), " THE ")
    return table(spark, sf, "documents").select("doc_id", F.array_join(lines, "|").alias("lines"))


@query(rf"""
    SELECT page_id, CASE WHEN strict = '' THEN soft ELSE strict END AS content FROM (
        SELECT page_id, {q.text(rf"regexp_replace({ARTICLE}, '(?is)<p\b[^>]*>.*?</p\s*>|<h1\b[^>]*>.*?</h1\s*>', '', 'g')")} AS strict,
               {q.text(q.br(ARTICLE))} AS soft FROM pages)
""")
def soft_fallback(spark, sf):
    article = cleanup.element(F.col("html"), "article")
    strict = cleanup.html_text(cleanup.drop_tags(article, ["p", "h1"], comments=False))
    soft = cleanup.html_text(cleanup.br_to_space(article))
    return table(spark, sf, "pages").select("page_id", cleanup.soft_fallback(strict, soft).alias("content"))


@query(f"SELECT page_id, {q.br('html')} AS html FROM pages")
def br_to_space(spark, sf):
    return table(spark, sf, "pages").select("page_id", cleanup.br_to_space(F.col("html")).alias("html"))


@query(f"SELECT page_id, {q.text(q.br(ARTICLE))} AS content FROM pages")
def html_text(spark, sf):
    text = cleanup.html_text(cleanup.br_to_space(cleanup.element(F.col("html"), "article")))
    return table(spark, sf, "pages").select("page_id", text.alias("content"))


@query(f"SELECT doc_id, {q.control('text')} AS text FROM documents")
def strip_control(spark, sf):
    return table(spark, sf, "documents").select("doc_id", cleanup.strip_control(F.col("text")).alias("text"))


@query(f"SELECT doc_id, regexp_replace({q.control('text')}, 'with[^\\n]*', '') AS text FROM documents")
def truncate_phrase(spark, sf):
    text = cleanup.truncate_phrase(cleanup.strip_control(F.col("text")), "with")
    return table(spark, sf, "documents").select("doc_id", text.alias("text"))


@query("SELECT item_id, trim(' ' || chr(9) || text || chr(10) || chr(13), ' ' || chr(9) || chr(10) || chr(13)) AS text FROM benchmark UNION ALL SELECT doc_id, trim(text, ' ' || chr(9) || chr(10) || chr(13)) FROM documents")
def btrim_text(spark, sf):
    padded = table(spark, sf, "benchmark").select("item_id", F.concat(F.lit(" \t"), "text", F.lit("\n\r")).alias("text"))
    documents = table(spark, sf, "documents").select(F.col("doc_id").alias("item_id"), "text")
    return padded.unionByName(documents).select("item_id", cleanup.btrim_text(F.col("text")).alias("text"))


@query(f"""
    SELECT page_id, array_to_string(list_filter({PARAGRAPHS}, lambda p: p <> {q.text(q.element('html', 'title'))}), '|') AS paragraphs
    FROM pages
""")
def drop_byline(spark, sf):
    title = cleanup.html_text(cleanup.element(F.col("html"), "title"))
    kept = cleanup.drop_byline(_paragraphs(), title)
    return table(spark, sf, "pages").select("page_id", F.array_join(kept, "|").alias("paragraphs"))


@query("SELECT doc_id, replace(replace(text, '‘', ''), '''', '') AS text FROM documents")
def strip_quotes(spark, sf):
    return table(spark, sf, "documents").select("doc_id", cleanup.strip_quotes(F.col("text")).alias("text"))
