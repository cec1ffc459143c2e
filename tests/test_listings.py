"""Grids, addresses, last pages and listing items."""

import datetime as dt

from pyspark.sql import functions as F

from kliping.operators import links
from kliping.plans import listings as plan
from kliping.rules.listings import listing_rules, whole_page_url
from kliping.schema import RUN_STATE
from kliping.sources import pages as sources
from kliping.sources import store


def test_range_end_is_excluded(spark):
    days = [r.date for r in plan.date_range(spark, "2018-08-01", "2018-08-04").collect()]
    assert sorted(days) == [dt.date(2018, 8, d) for d in (1, 2, 3)]
    assert plan.date_range(spark, "2018-08-04", "2018-08-04").count() == 0
    assert plan.date_range(spark, "2018-08-05", "2018-08-04").count() == 0


def test_pending(spark):
    categories = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 1)], "site string, category string, cat_ord int")
    grid = plan.seed_grid(categories, "2018-08-01", "2018-08-03")
    state = spark.createDataFrame([("a", dt.date(2018, 8, 1), 2, 7)], "site string, date date, cat_ord int, page int")
    left = {(r.site, r.date.day, r.cat_ord): r.first_page for r in plan.pending(grid, state).collect()}
    assert left == {("a", 1, 2): 7, ("a", 2, 1): 1, ("a", 2, 2): 1, ("b", 1, 1): 1, ("b", 2, 1): 1}


def test_addresses(spark):
    day = dt.date(2018, 8, 9)
    grid = spark.createDataFrame(
        [
            ("antara", "", "", day, 2), ("detik", "news", "", day, 1), ("detik", "inet", "", day, 3), ("gridoto", "", "", day, 1),
            ("okezone", "", "", day, 3), ("metrotv", "bola", "", day, 2), ("otosia", "berita", "", day, 1),
            ("otosia", "berita", "", day, 2), ("seva", "otomotif", "tips", day, 4), ("kompas", "sains", "", day, 1),
        ],
        "site string, category string, subcategory string, date date, page int",
    )
    got = {(r.site, r.category, r.page): r.listing_url for r in plan.listing_urls(grid, listing_rules(spark)).collect()}
    assert got == {
        ("antara", "", 2): "https://www.antaranews.com/search/%20/09-08-2018/09-08-2018/2",
        ("detik", "news", 1): "https://news.detik.com/indeks/all/1?date=08/09/2018",
        ("detik", "inet", 3): "https://inet.detik.com/indeks/3?date=08/09/2018",
        ("gridoto", "", 1): "https://www.gridoto.com/index?day=9&month=8&year=2018&section=all&page=1",
        ("okezone", "", 3): "https://index.okezone.com/bydate/index/2018/08/09/30/",
        ("metrotv", "bola", 2): "http://bola.metrotvnews.com/index/2018/08/09/30",
        ("otosia", "berita", 1): "https://www.otosia.com/berita/index.html",
        ("otosia", "berita", 2): "https://www.otosia.com/berita/index2.html",
        ("seva", "otomotif", 4): "https://www.seva.id/otomotif/blog/category/tips/page/4",
        ("kompas", "sains", 1): "https://indeks.kompas.com/sains/2018-08-09/1",
    }


PAGERS = {
    # one per way of telling the last page
    ("carmudi", 1): ('<div class="vw-page-navigation-pagination"><a>1</a><a> 17\n</a><a>next</a></div>', 17),
    ("kompas", 2): ('<div class="paging__wrap clearfix"><div class="paging__item"><a data-ci-pagination-page="3">3</a></div>'
                    '<div class="paging__item"><a data-ci-pagination-page="9">&raquo;</a></div></div>', 9),
    ("cintamobil", 1): ('<ul class="paging pull-right"><li><a href="/a/a/p2">2</a><li><a href="/a/a/p41">&gt;</a></ul>', 41),
    ("okezone", 1): ('<div class="pagination-indexs"><a href="https://index.okezone.com/bydate/index/2018/08/31/345/">L</a></div>', 24),
    ("oto", 1): ('<div class="news-count"><span>25</span></div>', 3),
    ("propertiterkini", 1): ('<div class="pagination"><span class="pages">Page 1 of 12</span></div>', 12),
    ("rumahku", 4): ('<div class="pagination"><ul><li class="next"><a>x</a></ul></div>', 5),
    ("antara", 3): ('<ul class="pagination pagination-sm"><li class="active"><a>3</a><li><a>8</a></ul>', 8),
    ("tempo", 1): ("<p>one page only</p>", 1),
    ("gridoto", 6): ("<p>no pager</p>", 6),
}


def test_last_pages(spark):
    rows = [(site, "u", page, html) for (site, page), (html, _) in PAGERS.items()]
    listings = spark.createDataFrame(rows, "site string, url string, page int, html string")
    got = {(r.site, r.page): r.last_page for r in plan.max_page(listings, listing_rules(spark)).collect()}
    assert got == {key: last for key, (_, last) in PAGERS.items()}


def test_items(spark):
    rows = [
        ("detik", "u1", 1, '<div class="rm_content"><article><span class="sub_judul">detikFoto</span><a href="/f">f</a></article>'
                           '<article><a name="x">no target</a><a href="http://d/1">1</a><a href="http://d/2">2</a></article>'
                           "<article>no link</article></div>"),
        ("carmudi", "u2", 1, '<div class="vw-loop vw-loop--medium vw-loop--medium-6 vw-loop--col-2">'
                             '<a class="vw-post-box__read-more vw-button vw-button--small vw-button--accent" href="http://c/1">x</a>'
                             '<a class="vw-button" href="http://c/no">y</a></div>'),
        ("rumah", "u3", 1, '<div class="box news-article-lists"><a href="/berita/1">x</a></div>'),
        ("rumahhokie", "u4", 1, '<div class="td_module_16 td_module_wrap td-animation-stack"><a href="http://r/no"></a>'
                                '<h3 class="entry-title td-module-title"><a href="http://r/1">x</a></h3><a class="td-post-category"> Tips </a></div>'
                                '<div class="td_module_16 td_module_wrap td-animation-stack">'
                                '<h3 class="entry-title td-module-title"><a href="http://r/2">x</a></h3></div>'),
    ]
    listings = spark.createDataFrame(rows, "site string, url string, page int, html string")
    got = sorted((r.site, r.pos, r.link, r.badge, r.label) for r in links.listing_links(listings, listing_rules(spark)).collect())
    assert got == [
        ("carmudi", 0, "http://c/1", None, None),
        ("detik", 0, "/f", "detikFoto", None),
        ("detik", 1, "http://d/1", None, None),
        ("rumah", 0, "https://www.rumah.com/berita/1", None, None),
        ("rumahhokie", 0, "http://r/1", None, "Tips"),
    ]


def test_category_names(spark):
    df = spark.createDataFrame([("tips-mobil",)], "slug string")
    assert df.select(plan.readable_category(F.col("slug"))).first()[0] == "tipsmobil"


def test_envelope_and_state(spark):
    bodies = spark.createDataFrame([(1, '{"html": "<a>x</a>"}'), (2, '{"html": ""}'), (3, "{}"), (4, "broken")], "k int, body string")
    assert [(r.k, r.html) for r in sources.unwrap_envelope(bodies, "body").collect()] == [(1, "<a>x</a>")]
    html = '<div id="__nuxt"></div><script>window.__NUXT__={"data":[{"listarticle":[{"articleUrl":"/0"},{"articleUrl":"/1"},{"articleUrl":"/2"}]}]};</script>'
    states = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "k int, html string")
    assert [(r.k, r.pos, r.link) for r in sources.state_links(states, "html").collect()] == [(1, 0, "/1"), (1, 1, "/2")]


def test_files(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>x\ny</p>")
    (tmp_path / "b.html").write_text("<p>z</p>")
    rows = sources.read_html_files(spark, str(tmp_path)).collect()
    assert sorted(r.html for r in rows) == ["<p>x\ny</p>", "<p>z</p>"]
    assert len({r.page_id for r in rows}) == 2


def test_read_whole_article(spark):
    df = spark.createDataFrame([("tribun", "http://t/1"), ("viva", "http://v/1")], "site string, url string")
    got = [r[0] for r in df.select(whole_page_url(F.col("site"), F.col("url"))).collect()]
    assert got == ["http://t/1?page=all", "http://v/1"]


def test_listing_forms(spark):
    state = '<div id="__nuxt"></div><script>window.__NUXT__={"data":[{"listarticle":[{"articleUrl":"/x"},{"articleUrl":"/a-1"},{"articleUrl":"/b-2"}]}]};</script>'
    envelope = '{"html": "<div class=\\"item-box\\"><a href=\\"http://h/1\\">x</a></div>", "n": 1}'
    viva = '<ul id="load_terbaru_content"><li><a href="/kat">K</a><a class="title-content" href="https://v/1">T</a></li></ul>'
    rows = [(1, "tirto", state), (2, "housingestate", envelope), (3, "viva", viva), (4, "housingestate", '{"html": ""}')]
    listings = spark.createDataFrame(rows, "page_id int, site string, html string")
    got = sorted((r.page_id, r.link) for r in links.listing_links(listings, listing_rules(spark)).collect())
    assert got == [(1, "https://tirto.id/a-1"), (1, "https://tirto.id/b-2"), (2, "http://h/1"), (3, "https://v/1")]


def test_a_saved_run_goes_on(spark, tmp_path):
    path = str(tmp_path / "state")
    for page, hour in ((3, 1), (7, 2)):
        row = ("a", "y", dt.date(2018, 8, 1), 2, page, dt.date(2018, 8, 3), dt.datetime(2018, 9, 1, hour))
        store.save_run_state(spark.createDataFrame([row], RUN_STATE), path)
    categories = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], "site string, category string, cat_ord int")
    last = store.latest_run_state(spark.read.parquet(path), by=["site"])
    left = plan.pending(plan.seed_grid(categories, "2018-08-01", "2018-08-03"), last)
    assert {(r.date.day, r.cat_ord): r.first_page for r in left.collect()} == {(1, 2): 7, (2, 1): 1, (2, 2): 1}
