"""Rules of the known sites on hand-written pages."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kliping.operators import extract
from kliping.rules.listings import DOMAINS, LISTINGS, assign_site
from kliping.rules.sites import SITES, site_rules
from tests.pages import PAGES


@pytest.fixture(scope="module")
def rows(spark):
    data = [(k, n, *page) for k, (n, page) in enumerate(PAGES.items())]
    shape = "page_id long, name string, site string, url string, category string, subcategory string, html string"
    out = extract.extract_fields(spark.createDataFrame(data, shape), site_rules(spark)).collect()
    assert len(out) == len(PAGES)
    return {r.name: r for r in out}


def stamp(*parts):
    return dt.datetime(*parts)


def test_meta_and_chains(rows):
    r = rows["detik_full"]
    assert (r.post_id, r.author, r.title, r.tags) == (4138819, "Penulis A", "Judul & isi", "satu,dua")
    assert (r.category, r.subcategory, r.comments, r.images) == ("news", "Berita", 12, "http://gambar/1.jpg")
    assert r.pubdate == stamp(2018, 7, 29, 6, 33, 50)
    assert r.content == "Kota- Isi satu duaBaca juga biasa"
    assert r.source == "detik" and r.reject_reason is None


def test_everything_after_a_marker(rows):
    r = rows["detik_after_marker"]
    assert r.content == "awaltandasisa"
    assert r.pubdate == stamp(2018, 7, 30, 6, 33)
    assert r.post_id == int(stamp(2018, 7, 30, 6, 33).replace(tzinfo=dt.timezone.utc).timestamp()) + len(r.url)
    assert (r.author, r.tags, r.images, r.comments) == ("", "", "", 0)


def test_reject_reasons(rows):
    reasons = {name: r.reject_reason for name, r in rows.items() if r.reject_reason}
    assert reasons == {
        "detik_no_crumb": "breadcrumb",
        "detik_video": "word_in_subcategory",
        "detik_no_body": "no_body",
        "antara_segment": "word_in_segment",
        "antara_no_jsonld": "jsonld",
        "tirto_caption": "word_in_caption",
        "idntimes_one_block": "jsonld",
        "otodriver_no_article": "article",
        "rumah_no_title": "title",
        "liputan6_photo": "word_in_title",
        "rumah123_nested_paragraph": "word_in_subcategory",
    }


def test_jsonld(rows):
    r = rows["antara"]
    assert (r.category, r.subcategory, r.author, r.post_id) == ("Dunia", "Asia", "Ani", 731)
    assert r.title == "Judul film"
    assert r.pubdate == stamp(2018, 7, 27, 15, 18)
    assert r.content == "Isi  akhir" and r.tags == "a,b" and r.images == "i.jpg"
    r = rows["okezone_first_when_undated"]
    assert (r.title, r.author, r.comments) == ("Pertama", "Budi", 7)
    assert r.post_id == int(stamp(2018, 8, 1, 10).replace(tzinfo=dt.timezone.utc).timestamp()) + len(r.url)
    assert (r.category, r.subcategory, r.content) == ("News", "Daerah", "tetapbiasa")
    r = rows["viva_nested"]
    assert (r.author, r.post_id, r.title, r.comments, r.content) == ("Citra", 1063, "Judul V", 3, "isiakhir")
    assert (r.category, r.subcategory) == ("Berita", "Politik")
    r = rows["idntimes"]
    assert (r.title, r.author, r.category, r.subcategory, r.images, r.content) == ("Judul I", "Dewi", "Tech", "Gadget", "i.png", "isi")
    assert r.pubdate == stamp(2018, 8, 3)
    r = rows["tempo_broken_json"]
    assert (r.title, r.author, r.category, r.subcategory, r.post_id, r.content) == ("Judul T", "Eka", "Nasional", "Hukum", 110, "satudua")


def test_dates(rows):
    assert rows["cintamobil_sibling"].pubdate == stamp(2018, 8, 5)
    assert rows["carreview_month"].pubdate == stamp(2018, 8, 6, 7, 8)
    assert rows["rajamobil_soft"].pubdate == stamp(2018, 8, 7)
    assert rows["rumahku_tail"].pubdate == stamp(2018, 8, 8, 9, 10)
    assert rows["rumah_byline"].pubdate == stamp(2018, 8, 9, 11, 12, 13)
    assert rows["metrotv_epoch"].pubdate == stamp(2018, 8, 9, 2)
    assert rows["tirto_second_div"].pubdate == stamp(2018, 8, 10)
    assert rows["sindonews_weekday"].pubdate == stamp(2018, 8, 10, 12, 13)
    assert rows["rumah123_nested"].pubdate == stamp(2018, 8, 11, 14, 15, 16)


def test_cleanup(rows):
    assert rows["cintamobil_sibling"].content == "isi"
    assert (rows["carreview_month"].content, rows["carreview_month"].tags) == ("isi", "a,b")
    assert rows["rajamobil_soft"].content == "semua di dalam div" and rows["rajamobil_soft"].tags == "x,y"
    assert rows["rumahku_tail"].content == "p0p1p2"
    assert rows["rumah_byline"].content == "isitebal"
    assert rows["metrotv_epoch"].content == "isi"
    assert rows["tirto_second_div"].content == "dua"
    assert rows["sindonews_weekday"].content == "isi"
    assert rows["rumah123_nested"].content == "isi"


def test_keys_and_bylines(rows):
    assert rows["cintamobil_sibling"].post_id == 77 and rows["cintamobil_sibling"].subcategory == "tipsmobil"
    assert rows["rumahku_tail"].subcategory == "Berita" and rows["rumahku_tail"].title == "Judul R"
    assert rows["metrotv_epoch"].post_id == 915 and rows["metrotv_epoch"].author == "Gita"
    assert rows["sindonews_weekday"].post_id == 1327 and rows["sindonews_weekday"].source == "Sindonews"
    assert rows["rumah123_nested"].post_id == 55
    assert rows["tirto_second_div"].author == "Hadi" and rows["tirto_second_div"].source == "tirto.id"


FULL = {
    # name: post_id, author, pubdate, category, subcategory, title, tags, images, comments, content
    "gridoto": (221, "Ina", stamp(2018, 8, 12, 13, 14, 15), "Otomotif", "Motor", "Judul G", "x,y", "g.jpg", 0, "isitebal"),
    "housingestate": (31, "Joko", stamp(2018, 8, 13, 1, 2, 3), "Properti", "Berita", "Judul H", "griya", "", 0, "isi"),
    "kompas": (501, "Kiki", stamp(2018, 8, 14, 5, 6, 7), "news", "Nasional", "Judul K", "p,q", "", 0, "isiBacabuku"),
    "liputan6": (3605, "Lia", stamp(2018, 8, 15, 8, 9, 10), "News", "Politik", "Judul L", "a,b", "l.jpg", 6, "isi"),
    "mobil123": (88, "Mia", stamp(2018, 8, 16, 11, 12), "Otomotif", "Tips", "Judul B", "k1, k2", "m.jpg", 0, "isi"),
    "oto": (12, "Nana", stamp(2018, 8, 17, 13, 14, 15), "Otomotif", "Motor", "Judul O", "o1,o2", "o.jpg", 0, "isi"),
    "otosia": (None, "Oki", stamp(2018, 8, 17, 14, 15), "Otomotif", "Berita", "Judul Q", "q", "q.jpg", 0, "isi satu"),
    "propertiterkini": (None, "Putri", stamp(2018, 8, 18, 16, 17, 18), "properti", "Berita", "Judul P", "p1,p2", "p.jpg", 0, "isi"),
    "rumahhokie": (2750, "Rara", stamp(2018, 8, 19, 1, 1, 1), "Properti", "Tips", "Judul Z", "", "", 0, "isidaftar"),
    "seva": (910, "Sari", stamp(2018, 8, 20, 2, 2, 2), "otomotif", "tips", "Judul W", "", "", 0, "isi & lain"),
    "tribun": (664, "Tari", stamp(2018, 8, 21, 3, 3, 3), "Nasional", "Politik", "Judul U", "t1,t2", "u.jpg", 0, "isitetap"),
}


@pytest.mark.parametrize("name", sorted(FULL))
def test_whole_record(rows, name):
    r = rows[name]
    post_id, *rest = FULL[name]
    if post_id is None:
        post_id = int(r.pubdate.replace(tzinfo=dt.timezone.utc).timestamp()) + len(r.url)
    got = (r.post_id, r.author, r.pubdate, r.category, r.subcategory, r.title, r.tags, r.images, r.comments, r.content)
    assert got == (post_id, *rest)
    assert r.reject_reason is None


def test_fallback_values(rows):
    assert (rows["tribun_no_category"].category, rows["tribun_no_category"].subcategory) == ("Berita", "")
    assert rows["detik_one_crumb"].subcategory == "" and rows["detik_one_crumb"].reject_reason is None


def test_section_numbers_and_double_escapes(spark):
    article = '<div class="left-content"><div class="entry-content detail-content">isi</div></div>'
    data = [
        (k, "otorider", f"http://otorider.com/{k}", "Otomotif", code, article) for k, code in enumerate(["1", "12", "7", None])
    ]
    data.append((9, "otomart", "http://otomart.id/9", "", "", '<a rel="category tag">A &amp;amp; B</a><h1 class="entry-title">x</h1><div class="entry-content">R&amp;amp;D</div>'))
    df = spark.createDataFrame(data, "page_id int, site string, url string, category string, subcategory string, html string")
    got = {r.page_id: r for r in extract.extract_fields(df, site_rules(spark)).collect()}
    assert [got[k].subcategory for k in range(4)] == ["Tips Modifikasi", "Berita", "Komunitas", "Komunitas"]
    assert (got[9].subcategory, got[9].content) == ("A & B", "R&D")


def test_every_site_has_rules():
    assert set(LISTINGS) == set(SITES) == set(DOMAINS.values())
    assert len(SITES) == 30


def test_sites_by_domain(spark):
    urls = ["https://news.detik.com/x", "http://www.viva.co.id/y", "https://detik.com/z", "https://other.org/"]
    df = assign_site(spark.createDataFrame([(u,) for u in urls], "url string"))
    assert [r.site for r in df.collect()] == ["detik", "viva", "detik", None]


def test_own_rule_kind(spark):
    extract.register_rule_kind("url_length", lambda page, rule: F.length(page["url"]).cast("string"))
    try:
        own = {"own": {"fields": {"post_id": [{"kind": "url_length", "steps": [], "take": None, "block": None, "path": None, "pattern": None, "remove": None}]}, "body": SITES["kompas"]["body"]}}
        df = spark.createDataFrame([(1, "own", "http://a", "<div class='read__content'>x</div>")], "page_id long, site string, url string, html string")
        row = extract.extract_fields(df, site_rules(spark, own)).first()
        assert row.post_id == 8 and row.content == "x"
    finally:
        extract._KINDS.pop("url_length")


def test_unreadable_jsonld_is_rejected(spark):
    html = '<script type="application/ld+json">{"headline": "A" broken</script><article>x</article>'
    pages = spark.createDataFrame([(1, "tempo", "https://tempo.co/1", html)], "page_id int, site string, url string, html string")
    assert [r.reject_reason for r in extract.extract_fields(pages, site_rules(spark)).collect()] == ["bad_jsonld"]
