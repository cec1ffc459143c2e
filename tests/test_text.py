"""Text, date and key expressions."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kliping.functions import cleanup, dates, markup


def one(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r.x for r in df.select("k", fn(F.col("v")).alias("x")).orderBy("k").collect()]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\r\x1c\x85\xa0 　ab<>é", max_size=20), min_size=30, max_size=60))
def test_strip_is_pythons_strip(spark, values):
    assert one(spark, values, cleanup.strip_text) == [v.strip() for v in values]
    cleaned = one(spark, values, cleanup.strip_control)
    assert cleaned == [v.translate({9: None, 10: None, 13: None}) for v in values]


def test_text_parts_join_with_nothing(spark):
    values = ["<p> a </p> <p>b<b> c</b></p>", "x < y <b>z</b>", "<!-- <p>no</p> -->t", "", None]
    assert one(spark, values, cleanup.html_text) == ["abc", "x < yz", "t", "", None]
    assert one(spark, ["a<br/>b<BR >c"], lambda c: cleanup.html_text(cleanup.br_to_space(c))) == ["a b c"]


def test_normal_form_comes_after_the_strip(spark):
    values = ["é", "a\xa0b", "ﬁ", "´x", None, "plain"]
    assert one(spark, values, cleanup.nfkd) == ["é", "a b", "fi", " ́x", None, "plain"]
    assert one(spark, values, cleanup.normalized) == ["é", "a b", "fi", " ́x", None, "plain"]


def test_entities(spark):
    values = ["R&amp;amp;D &#8217;x&eacute;&nbsp;", None]
    assert one(spark, values, cleanup.unescape) == ["R&amp;D ’xé\xa0", None]
    assert one(spark, values, cleanup.unescape_common) == ["R&amp;D &#8217;x&eacute;\xa0", None]


def test_cuts(spark):
    assert one(spark, ["a Tonton juga b", "a"], lambda c: cleanup.truncate_phrase(c, "Tonton juga")) == ["a ", "a"]
    assert one(spark, ["ab|c|d", "x"], lambda c: cleanup.cut_after(c, "|")) == ["ab", "x"]
    assert one(spark, ["‘a' b"], cleanup.strip_quotes) == ["a b"]
    tail = lambda c: cleanup.drop_tail(F.split(c, ","), 7, c, "INFO")
    assert one(spark, ["1,2,info", "1,2,3,4,5,6,info", "0,1,2,3,4,5,6,7,8,9,info", "1,2"], tail) == [[], [], ["0", "1", "2", "3"], ["1", "2"]]


def test_meta_in_both_orders(spark):
    pages = ['<meta name="a" content="1">', "<meta content='2' property='a'>", "<meta name='b' content='3'>"]
    assert one(spark, pages, lambda c: markup.meta_content(c, "a")) == ["1", "2", None]
    assert one(spark, pages, lambda c: markup.fallback(markup.meta_content(c, "a"), markup.meta_content(c, "b"))) == ["1", "2", "3"]


def test_local_dates(spark):
    months = ["Januari", "Februari", "Maret", "April", "Mei", "Juni", "Juli", "Agustus", "September", "Oktober", "November", "Desember"]
    short = ["Jan", "Feb", "Mar", "Apr", "Mei", "Jun", "Jul", "Agt", "Sep", "Okt", "Nop", "Des"]
    values = [f"Jum'at, 3 {m} 2018 - 07:08 WIB" for m in months] + [f"03-{m}-2018 07:08" for m in short]
    values += ["3 Ags 2018, 07:08", "3 Agu 2018 07:08", "3 Dec 2018", "32 Mei 2018", "3 Foo 2018", "tidak ada", None]
    got = one(spark, values, dates.parse_local_dates)
    stamps = [dt.datetime(2018, m, 3, 7, 8) for m in range(1, 13)]
    assert got == stamps * 2 + [dt.datetime(2018, 8, 3, 7, 8)] * 2 + [dt.datetime(2018, 12, 3)] + [None] * 4


def test_iso_keeps_the_wall_clock(spark):
    values = ["2018-07-27T15:18:00+07:00", "2018-07-27T15:18:00+00:00", " 2018-07-27T15:18:00", "x"]
    assert one(spark, values, dates.iso_wallclock) == [dt.datetime(2018, 7, 27, 15, 18)] * 3 + [None]
    assert one(spark, ["1533780000", "x"], dates.epoch_timestamp) == [dt.datetime(2018, 8, 9, 2), None]


def test_keys_and_counts(spark):
    key = lambda c: dates.article_key([c, F.regexp_extract(c, r"-(\d+)$", 1)], F.lit(None).cast("timestamp"), F.lit("http://x"))
    assert one(spark, ["12", "a-34", "a", "", None], key) == [12, 34, 3661 + 8, 3669, 3669]
    assert one(spark, ["12 Komentar", "", None, "x"], dates.comment_count) == [12, 0, 0, 0]
    parts = one(spark, ["Ani | 3 Mei 2018", "Budi"], lambda c: dates.split_byline(c, r"\|"))
    assert parts == [["Ani", "3 Mei 2018"], ["Budi"]]
    back = one(spark, [dt.datetime(2018, 1, 1), None], lambda c: dates.with_sentinel(c), "timestamp")
    assert back == [dt.datetime(2018, 1, 1), dt.datetime(1970, 1, 1, 1, 1, 1)]
