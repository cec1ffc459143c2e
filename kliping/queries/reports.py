"""Reports over articles."""

from pyspark.sql import functions as F

from kliping.functions import urls
from kliping.operators import audit
from kliping.queries import sqltext as q
from kliping.queries.registry import days_as_text, query
from kliping.session import table


@query("""
    SELECT event_type, ts::DATE::VARCHAR AS day, count(*) AS n, min(ts) AS first_at, max(ts) AS last_at
    FROM events GROUP BY ALL
""")
def coverage(spark, sf):
    return days_as_text(audit.coverage(table(spark, sf, "events"), "ts", ["event_type"]))


@query("""
    SELECT event_type, day::VARCHAR AS day, grouping_id(event_type, day) AS level, count(*) AS n FROM (SELECT event_type, ts::DATE AS day FROM events)
    GROUP BY ROLLUP (event_type, day)
""")
def coverage_rollup(spark, sf):
    return days_as_text(audit.coverage_rollup(table(spark, sf, "events"), "ts", ["event_type"]))


@query("""
    WITH days AS (SELECT DISTINCT user_id, ts::DATE AS day FROM events),
    spans AS (SELECT user_id, min(day) AS lo, max(day) AS hi FROM days GROUP BY user_id),
    expected AS (SELECT user_id, lo + n::INTEGER AS day FROM spans, range(0, 10000) t(n) WHERE lo + n::INTEGER <= hi)
    SELECT user_id, day::VARCHAR AS day FROM (SELECT * FROM expected EXCEPT SELECT * FROM days)
""")
def missing_days(spark, sf):
    return days_as_text(audit.missing_days(table(spark, sf, "events"), "ts", "user_id"))


@query(f"""
    SELECT site, post_id, count(DISTINCT url_key) AS n_urls FROM (
        SELECT {q.HOST} AS site, length(url)::INTEGER AS post_id, {q.KEY} AS url_key FROM pages)
    GROUP BY site, post_id HAVING count(DISTINCT url_key) > 1
""")
def key_collisions(spark, sf):
    """The pages carry no date, so the synthetic number is the URL length."""
    rows = table(spark, sf, "pages").select(
        urls.host(F.col("url")).alias("site"), F.length("url").alias("post_id"), urls.canonical(F.col("url")).alias("url_key")
    )
    return audit.key_collisions(rows, "site", "post_id")


@query("""
    SELECT source, count(*) AS n, avg(CASE WHEN text <> '' THEN 1.0 ELSE 0.0 END) AS content_rate,
           avg(CASE WHEN quality IS NOT NULL THEN 1.0 ELSE 0.0 END) AS quality_rate,
           avg(CASE WHEN toxic > 0 THEN 1.0 ELSE 0.0 END) AS toxic_rate
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY source
""")
def fill_rates(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "source", (F.col("text") != "").alias("has_text")).join(
        table(spark, sf, "labels"), "doc_id", "left"
    )
    filled = {
        "content": F.col("has_text"),
        "quality": F.col("quality").isNotNull(),
        "toxic": F.col("toxic") > 0,
    }
    return audit.fill_rates(rows, "source", filled)


@query("""
    WITH daily AS (SELECT user_id, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL)
    SELECT user_id, day::VARCHAR AS day, n, (lag(day) OVER w)::VARCHAR AS previous_day, (day - lag(day) OVER w)::DOUBLE AS gap_days
    FROM daily WINDOW w AS (PARTITION BY user_id ORDER BY day)
""")
def publish_gaps(spark, sf):
    gaps = audit.publish_gaps(table(spark, sf, "events"), "ts", "user_id")
    return days_as_text(gaps.withColumn("gap_days", F.col("gap_days").cast("double")))


@query("""
    SELECT event_id, event_type, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC)::INTEGER AS rank
    FROM events QUALIFY rank <= 10
""")
def latest_n(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return audit.latest_n(rows, "event_type", 10, [F.desc("ts"), F.desc("event_id")])


@query(f"""
    WITH lines AS (SELECT DISTINCT doc_id, source, line FROM (
        SELECT doc_id, source, {q.strip('u')} AS line
        FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS u FROM documents)) WHERE line <> ''),
    totals AS (SELECT source, count(*) AS total_docs FROM documents GROUP BY source),
    counted AS (SELECT source, line, count(*) AS n_docs FROM lines GROUP BY ALL HAVING count(*) >= 2)
    SELECT c.source, c.line, n_docs, total_docs, n_docs / total_docs AS share
    FROM counted c JOIN totals t ON t.source = c.source WHERE n_docs / total_docs >= 0.02
""")
def frequent_lines(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "source", "text")
    return audit.frequent_lines(rows, "doc_id", "text", "source", 0.02)
