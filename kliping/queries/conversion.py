"""Dates, numbers and keys."""

from pyspark.sql import functions as F

from kliping.functions import dates, urls
from kliping.queries import sqltext as q
from kliping.queries.registry import query
from kliping.session import table

FORMATS = {
    "view": "yyyy/MM/dd HH:mm:ss",
    "click": "yyyy-MM-dd'T'HH:mm:ss",
    "signup": "yyyy-MM-dd HH:mm:ss",
    "purchase": "dd/MM/yyyy",
}
MONTHS = ["Januari", "Februari", "Maret", "April", "Mei", "Juni", "Juli", "Agustus", "September", "Oktober", "November", "Desember"]
DAYS = ["Senin", "Selasa", "Rabu", "Kamis", "Jum'at", "Sabtu", "Minggu"]


@query("""
    SELECT event_id, CASE event_type WHEN 'purchase' THEN date_trunc('day', ts)::TIMESTAMP
                                     WHEN 'error' THEN NULL ELSE date_trunc('second', ts)::TIMESTAMP END AS pubdate
    FROM events
""")
def parse_dates(spark, sf):
    """Times written in four formats (and one that none fits), then parsed."""
    text = F.lit("no date")
    for kind, form in FORMATS.items():
        text = F.when(F.col("event_type") == kind, F.date_format("ts", form)).otherwise(text)
    padded = F.concat(F.lit(" \t"), text, F.lit("\n"))
    return table(spark, sf, "events").select("event_id", dates.parse_dates(padded, list(FORMATS.values())).alias("pubdate"))


@query("""
    SELECT event_id, CASE event_type WHEN 'view' THEN date_trunc('day', ts)::TIMESTAMP
                                     ELSE date_trunc('minute', ts)::TIMESTAMP END AS pubdate
    FROM events
""")
def parse_dates_id(spark, sf):
    """Times written with local day and month words, then parsed."""
    ts = F.col("ts")
    month = F.get(F.array(*[F.lit(m) for m in MONTHS]), F.month(ts) - 1)
    weekday = F.get(F.array(*[F.lit(d) for d in DAYS]), F.weekday(ts))
    clock = F.date_format(ts, "HH:mm")
    day, year = F.day(ts).cast("string"), F.year(ts).cast("string")
    text = (
        F.when(F.col("event_type") == "view", F.concat_ws(" ", day, month, year))
        .when(F.col("event_type") == "click", F.concat(weekday, F.lit(", "), F.concat_ws(" ", day, month, year, clock), F.lit(" WIB")))
        .when(F.col("event_type") == "signup", F.concat(weekday, F.lit(", "), F.concat_ws(" ", day, month, year), F.lit(" - "), clock))
        .when(F.col("event_type") == "purchase", F.concat(F.concat_ws("-", F.lpad(day, 2, "0"), F.substring(month, 1, 3), year), F.lit(" "), clock))
        .otherwise(F.concat(F.concat_ws(" ", day, F.substring(month, 1, 3), year), F.lit(", "), clock))
    )
    return table(spark, sf, "events").select("event_id", dates.parse_local_dates(text).alias("pubdate"))


@query("SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS pubdate FROM events")
def epoch_ts(spark, sf):
    seconds = F.unix_timestamp("ts").cast("string")
    return table(spark, sf, "events").select("event_id", dates.epoch_timestamp(seconds).alias("pubdate"))


@query("SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS pubdate FROM events")
def iso_wallclock(spark, sf):
    """The written offset differs by event type and must not move the time."""
    offset = F.when(F.col("event_type") == "view", "+07:00").when(F.col("event_type") == "click", "Z").otherwise(".000+00:00")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), offset)
    return table(spark, sf, "events").select("event_id", dates.iso_wallclock(text).alias("pubdate"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '1970-01-01 01:01:01' ELSE o_orderdate END AS stored,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS pubdate, o_orderstatus = 'P' AS pubdate_missing,
           strftime(CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '1970-01-01 01:01:01' ELSE o_orderdate END, '%Y-%m-%d %H:%M:%S') AS stamp
    FROM orders
""")
def sentinel_dates(spark, sf):
    found = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    stored = dates.with_sentinel(found)
    back = dates.without_sentinel(stored)
    return table(spark, sf, "orders").select(
        "o_orderkey", stored.alias("stored"), back.alias("pubdate"), back.isNull().alias("pubdate_missing"),
        dates.stamp_text(stored).alias("stamp"),
    )


@query(rf"""
    SELECT page_id, coalesce(try_cast({q.SEGMENTS}[-1] AS BIGINT),
                             try_cast(nullif(regexp_extract({q.SEGMENTS}[-1], '^([3-9]\d*)\.html$', 1), '') AS BIGINT),
                             epoch(TIMESTAMP '2018-07-27 15:18:00')::BIGINT + length(url)) AS post_id
    FROM pages
""")
def article_key(spark, sf):
    """Number of the last segment, digits before its suffix, else the synthetic one."""
    tail = F.try_element_at(urls.segments(F.col("url")), F.lit(-1))
    stamp = F.lit("2018-07-27 15:18:00").cast("timestamp")
    key = dates.article_key([tail, F.regexp_extract(tail, r"^([3-9]\d*)\.html$", 1)], stamp, F.col("url"))
    return table(spark, sf, "pages").select("page_id", key.alias("post_id"))


@query("""
    SELECT event_id, coalesce(try_cast(regexp_replace(CASE WHEN event_type = 'error' THEN 'Komentar' ELSE props END,
                                                      '[^0-9]', '', 'g') AS INTEGER), 0) AS comments
    FROM events
""")
def comment_count(spark, sf):
    text = F.when(F.col("event_type") == "error", F.lit("Komentar")).otherwise(F.col("props"))
    return table(spark, sf, "events").select("event_id", dates.comment_count(text).alias("comments"))
