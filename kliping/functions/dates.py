"""Dates, keys and numbers as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Month words of the portals, with the spellings that occur beside the standard
# ones; only the first three letters are looked up.
MONTH_WORDS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "mei": 5, "may": 5, "jun": 6, "jul": 7,
    "agu": 8, "ags": 8, "agt": 8, "aug": 8, "sep": 9, "okt": 10, "oct": 10,
    "nov": 11, "nop": 11, "des": 12, "dec": 12,
}
# Stands for "no date" in stored rows.
SENTINEL = "1970-01-01 01:01:01"
STAMP = "yyyy-MM-dd HH:mm:ss"
# -----------------------------------------------------------------------------

LOCAL_DATE = (
    r"(\d{1,2})[\s-]+([A-Za-z]{3})[A-Za-z]*\.?[\s-]+(\d{4})"
    r"(?:[\s,-]+(\d{1,2})[:.](\d{2})(?::(\d{2}))?)?"
)


def parse_dates(text: Column, formats: Sequence[str], locale: str | None = None) -> Column:
    """The first format that fits; NULL when none does.

    With ``locale='id'`` texts with local month words are read as well.
    """
    if locale not in (None, "id"):
        raise ValueError(f"no month words for locale {locale!r}")
    trimmed = F.btrim(text, F.lit(" \t\n\r"))
    local = [] if locale is None else [parse_local_dates(trimmed)]
    return F.coalesce(*[F.try_to_timestamp(trimmed, F.lit(f)) for f in formats], *local)


def parse_local_dates(text: Column) -> Column:
    """Day, month word and year, with an optional time; NULL when absent.

    Weekday names, time zone words and the separators between the parts are
    ignored, so one expression serves all local-language formats.
    """

    months = F.create_map(*[F.lit(x) for pair in MONTH_WORDS.items() for x in pair])
    # One pass of the pattern per text: the groups come back as one list.
    found = F.regexp_replace(text, rf"(?s)^.*?{LOCAL_DATE}.*$", "$1\u0001$2\u0001$3\u0001$4\u0001$5\u0001$6")

    def stamp(part: Column) -> Column:
        def number(k: int) -> Column:
            return F.get(part, k).try_cast("int")

        month = F.try_element_at(months, F.lower(F.get(part, 1)))
        clock = [F.coalesce(number(k), F.lit(0)) for k in (3, 4)]
        second = F.coalesce(F.get(part, 5).try_cast("decimal(16,6)"), F.lit(0).cast("decimal(16,6)"))
        return F.try_make_timestamp(number(2), month, number(0), *clock, second)

    return F.get(F.transform(F.array(F.split(found, "\u0001")), stamp), 0)


def iso_wallclock(text: Column) -> Column:
    """ISO text without its offset: the wall clock is what is stored."""
    return F.try_to_timestamp(F.substring(F.btrim(text), 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss"))


def epoch_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds.try_cast("bigint"))


def with_sentinel(stamp: Column) -> Column:
    """The stored form of a missing date."""
    return F.coalesce(stamp, F.lit(SENTINEL).cast("timestamp"))


def without_sentinel(stamp: Column) -> Column:
    return F.nullif(stamp, F.lit(SENTINEL).cast("timestamp"))


def stamp_text(stamp: Column) -> Column:
    return F.date_format(stamp, STAMP)


def comment_count(text: Column) -> Column:
    """Digits of a counter text, 0 when there are none."""
    return F.coalesce(F.regexp_replace(text, "[^0-9]", "").try_cast("int"), F.lit(0))


def article_key(candidates: Sequence[Column], stamp: Column, url: Column) -> Column:
    """First numeric candidate, else seconds of the date plus URL length."""
    numeric = [c.try_cast("bigint") for c in candidates]
    synthetic = F.unix_timestamp(with_sentinel(stamp)) + F.length(url)
    return reduce(F.coalesce, [*numeric, synthetic])


def split_byline(text: Column, separator: str) -> Column:
    """Trimmed parts of an "author | date" line."""
    return F.transform(F.split(text, separator), lambda p: F.btrim(p))
