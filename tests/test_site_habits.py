"""Habits of single sites: dated listings, escaped JSON-LD, the body by category; pages of sites without rules."""

import datetime as dt

from kliping.operators import extract, links
from kliping.plans import listings as plan
from kliping.rules.listings import listing_rules
from kliping.rules.sites import site_rules


def test_dated_listing_keeps_the_items_of_its_day(spark):
    def item(name, day):
        return f'<li>{day}<a class="title-content" href="http://v/{name}">x</a></li>'

    html = '<ul id="load_terbaru_content">' + "".join([
        item("a", '<div class="date">20 September 2018 | 10:15</div>'), item("b", '<div class="date">19 September 2018 | 23:59</div>'),
        item("c", ""), item("d", '<div class="date">20 September 2018</div>'), item("e", '<div class="date">besok</div>'),
    ]) + "</ul>"
    frame = spark.createDataFrame([("viva", dt.date(2018, 9, 20), html)], "site string, date date, html string")
    got = links.listing_links(frame, listing_rules(spark)).collect()
    assert sorted((r.pos, r.link) for r in got) == [(0, "http://v/a"), (3, "http://v/d")]
    undated = links.listing_links(frame.drop("date"), listing_rules(spark)).collect()
    assert sorted(r.link[-1] for r in undated) == ["a", "b", "c", "d", "e"]


def test_pages_of_unknown_sites_leave_a_trace(spark):
    frame = spark.createDataFrame([("unheard", 2, "<a href='x'>y</a>"), (None, 1, None)], "site string, page int, html string")
    got = links.listing_links(frame, listing_rules(spark)).collect()
    assert [(r.link, r.pos, r.reject_reason) for r in got] == [(None, None, "no_rules")] * 2
    assert [r.last_page for r in plan.max_page(frame, listing_rules(spark)).collect()] == [None, None]
    grid = spark.createDataFrame([("unheard", "news", dt.date(2018, 9, 1), 1)], "site string, category string, date date, page int")
    assert [r.listing_url for r in plan.listing_urls(grid, listing_rules(spark)).collect()] == [None]


def test_no_hint_on_frames_of_the_caller(spark):
    frame = spark.createDataFrame([("detik", 1, "<p>x</p>", "news", dt.date(2018, 9, 1))], "site string, page int, html string, category string, date date")
    for made in (plan.max_page(frame, listing_rules(spark)), plan.listing_urls(frame, listing_rules(spark))):
        assert "ResolvedHint" not in made._jdf.queryExecution().analyzed().toString()


def fields(spark, site, html, url="http://x/1", **carried):
    row = {"page_id": 1, "site": site, "url": url, "html": html, **carried}
    schema = "page_id int, site string, url string, html string" + "".join(f", {c} string" for c in carried)
    return extract.extract_fields(spark.createDataFrame([tuple(row.values())], schema), site_rules(spark)).first()


def test_escaped_json_is_resolved_before_it_is_parsed(spark):
    first = "{&quot;headline&quot;: &quot;A &amp;amp; B&quot;, &quot;datePublished&quot;: &quot;2018-09-20T10:00:00+07:00&quot;}"
    plain = '{"headline": "A &amp; B", "articleBody": "he said "no", twice", "datePublished": "2018-09-20T10:00:00+07:00"}'
    second = '{"itemListElement": [{"item": {"name": "H"}}, {"item": {"name": "news"}}, {"item": {"name": "politik"}}]}'
    for block, title in ((plain, "A & B"), (first, "A &amp; B")):
        html = (
            f'<script type="application/ld+json">{block}</script><script type="application/ld+json">{second}</script>'
            '<article itemtype="http://schema.org/NewsArticle"><div id="isi"><p>isi</p></div></article>'
        )
        got = fields(spark, "tempo", html)
        assert (got.reject_reason, got.title, got.category, got.content) == (None, title, "news", "isi")
        assert got.pubdate == dt.datetime(2018, 9, 20, 10)


def test_body_by_category(spark):
    html = (
        '<div class="breadcrumb"><a>H</a><a>Berita</a></div><article><div class="detail_text">satu</div>'
        '<div id="detikdetailtext">dua</div></article>'
    )
    assert fields(spark, "detik", html, category="news").content == "satu"
    assert fields(spark, "detik", html, category="finance").content == "dua"
    assert fields(spark, "detik", html).content == "satu"
    only_news = html.replace('<div id="detikdetailtext">dua</div>', "")
    assert fields(spark, "detik", only_news, category="finance").reject_reason == "no_body"
    wide = '<div class="breadcrumb"><a>H</a><a>B</a></div><article></article><div class="read__content full mt20">tiga</div>'
    assert fields(spark, "detik", wide, category="finance").content == "tiga"
    assert fields(spark, "detik", wide, category="news").reject_reason == "no_body"
