"""Reports over the article table.

Each report first shrinks its input by a partial aggregate; windows run over
daily totals only, whose number per source is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kliping.functions import cleanup
from kliping.plans import listings

SALTS = 64


def coverage(rows: DataFrame, stamp: str, by: Sequence[str]) -> DataFrame:
    """Articles per group and day, with the first and last time."""
    return rows.groupBy(*by, F.to_date(stamp).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.min(stamp).alias("first_at"), F.max(stamp).alias("last_at")
    )


def coverage_rollup(rows: DataFrame, stamp: str, by: Sequence[str]) -> DataFrame:
    """Daily counts with totals per group and over all, told apart by ``level``.

    ``level`` is the grouping id, 0 for days: a missing date is a day of its own.

    The totals are rolled up from daily counts, so the multiplied rows are
    aggregates and not articles.
    """
    daily = rows.groupBy(*by, F.to_date(stamp).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return daily.rollup(*by, "day").agg(F.grouping_id().alias("level"), F.sum("n").alias("n"))


def missing_days(rows: DataFrame, stamp: str, source: str) -> DataFrame:
    """Days without articles between a source's first and last day."""
    days = rows.select(source, F.to_date(stamp).alias("day")).distinct()
    spans = days.groupBy(source).agg(F.min("day").alias("_lo"), F.date_add(F.max("day"), 1).alias("_hi"))
    expected = listings.explode_dates(spans, F.col("_lo"), F.col("_hi"), "day").select(source, "day")
    return expected.join(days, [source, "day"], "left_anti")


def key_collisions(rows: DataFrame, source: str, post_id: str, key: str = "url_key") -> DataFrame:
    """Article numbers that stand for more than one address of a source."""
    return (
        rows.groupBy(source, post_id)
        .agg(F.countDistinct(key).alias("n_urls"))
        .filter(F.col("n_urls") > 1)
    )


def fill_rates(rows: DataFrame, source: str, filled: Mapping[str, Column]) -> DataFrame:
    """Rows per source and the share that has each field filled."""
    rates = [F.avg(F.when(test, 1.0).otherwise(0.0)).alias(f"{name}_rate") for name, test in filled.items()]
    return rows.groupBy(source).agg(F.count(F.lit(1)).alias("n"), *rates)


def publish_gaps(rows: DataFrame, stamp: str, source: str) -> DataFrame:
    """Days between the publishing days of a source, with the day's articles."""
    daily = rows.groupBy(source, F.to_date(stamp).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    before = F.lag("day").over(W.partitionBy(source).orderBy("day"))
    return daily.withColumn("previous_day", before).withColumn("gap_days", F.date_diff("day", "previous_day"))


def latest_n(rows: DataFrame, source: str, n: int, order: Sequence[Column]) -> DataFrame:
    """The latest ``n`` rows per source, ``order`` being unique within it.

    A source is first split into ``SALTS`` parts, of which each keeps its
    latest ``n``; so no task sorts a hot source, whatever ``n`` is, and the last
    step ranks at most ``SALTS * n`` rows of it.
    """
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))
    part = F.row_number().over(W.partitionBy(source, "_salt").orderBy(*order))
    few = rows.withColumn("_salt", salt).withColumn("_part", part).filter(F.col("_part") <= n).drop("_salt", "_part")
    rank = F.row_number().over(W.partitionBy(source).orderBy(*order))
    return few.withColumn("rank", rank).filter(F.col("rank") <= n)


def frequent_lines(rows: DataFrame, row_id: str, text: str, source: str, share: float, least: int = 2) -> DataFrame:
    """Lines that recur in many articles of a source.

    A line is one that ``least`` articles at least and ``share`` of them have.
    It counts once per article: it is made distinct inside the row, so the
    shuffle carries partial counts and never the articles of one line.
    """
    lines = F.array_distinct(F.filter(F.transform(F.split(text, "\n"), cleanup.strip_text), lambda x: x != ""))
    per_line = (
        rows.select(source, F.explode(lines).alias("line"))
        .groupBy(source, "line")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .filter(F.col("n_docs") >= least)
    )
    totals = rows.groupBy(source).agg(F.count(F.lit(1)).alias("total_docs"))
    return (
        per_line.join(totals, source)
        .withColumn("share", F.col("n_docs") / F.col("total_docs"))
        .filter(F.col("share") >= share)
    )
