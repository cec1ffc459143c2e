"""Store, dumps, run state and streams on real folders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kliping.functions import cleanup
from kliping.operators import repair
from kliping.rules.listings import assign_site
from kliping.rules.sites import site_rules
from kliping.sources import store
from kliping.streaming import ingest


def article(k, url, source="detik", day=1, content="isi"):
    return (k, k, "", dt.datetime(2018, 8, day), "news", "", content, 0, "", f"judul {k}", "", url, source)


SHAPE = (
    "row long, post_id long, author string, pubdate timestamp, category string, subcategory string, content string, "
    "comments int, images string, title string, tags string, url string, source string"
)


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SHAPE)


def outcomes(df):
    return {r.row: r.outcome for r in df.collect()}


def test_insert_twice(spark, tmp_path):
    path = str(tmp_path / "store")
    assert store.read_store(spark, path).count() == 0
    rows = [article(1, "http://a/1"), article(2, "http://a/1?page=all"), article(3, "http://a/3", day=2), article(4, "http://v/1", "viva")]
    assert outcomes(store.insert_if_absent(batch(spark, *rows), path, "row")) == {1: "inserted", 2: "duplicate", 3: "inserted", 4: "inserted"}
    assert store.read_store(spark, path).count() == 3
    again = outcomes(store.insert_if_absent(batch(spark, *rows, article(5, "http://a/5")), path, "row"))
    assert again == {1: "duplicate", 2: "duplicate", 3: "duplicate", 4: "duplicate", 5: "inserted"}
    kept = store.read_store(spark, path)
    assert kept.count() == 4 and kept.select("url_key").distinct().count() == 4
    plan = store.read_store(spark, path, F.col("source") == "viva", ["url", "title"])
    assert [r.url for r in plan.collect()] == ["http://v/1"]
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in text and "content" not in text


def test_rejected_rows_stay_out(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = batch(spark, article(1, "http://a/1"), article(2, "http://a/1")).withColumn(
        "reject_reason", F.when(F.col("row") == 1, "no_body")
    )
    assert outcomes(store.insert_if_absent(rows, path, "row")) == {1: "rejected", 2: "inserted"}
    assert [r.post_id for r in store.read_store(spark, path).collect()] == [2]


def test_repair(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [article(1, "http://a/1", content=""), article(2, "http://a/2", content="‘x'"), article(3, "http://a/3", day=2), article(4, "http://v/4", "viva", content="")]
    store.insert_if_absent(batch(spark, *rows), path, "row").count()
    untouched = sorted(p.name for p in (tmp_path / "store" / "source=detik" / "pub_date=2018-08-02").glob("*.parquet"))
    rows = store.read_store(spark, path)
    empty = repair.candidates(rows, (F.col("content") == "") & (F.col("source") == "detik"), ["url_key"])
    quotes = repair.candidates(rows, F.col("content").contains("'"), ["url_key", "content"])
    fixes = empty.select("url_key", F.lit("baru").alias("content")).unionByName(
        quotes.select("url_key", cleanup.strip_quotes(F.col("content")).alias("content"))
    )
    store.repair_partitions(rows, fixes, path, ["content"])
    spark.catalog.refreshByPath(path)
    assert {r.post_id: r.content for r in store.read_store(spark, path).collect()} == {1: "baru", 2: "x", 3: "isi", 4: ""}
    assert untouched == sorted(p.name for p in (tmp_path / "store" / "source=detik" / "pub_date=2018-08-02").glob("*.parquet"))
    with pytest.raises(ValueError):
        store.repair_partitions(rows, fixes, path, ["pub_date"])


def test_repair_moves_rows_with_their_dates(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [article(1, "http://a/1"), article(2, "http://a/2", day=2), article(3, "http://a/3", day=3)]
    store.insert_if_absent(batch(spark, *rows), path, "row").count()
    # Copies of a fix double no row.
    fixes = spark.createDataFrame([("http://a/1", dt.datetime(2018, 8, 2, 5))] * 2 + [("http://a/3", None)], "url_key string, pubdate timestamp")
    store.repair_partitions(store.read_store(spark, path), fixes, path, ["pubdate"])
    spark.catalog.refreshByPath(path)
    days = sorted((r.post_id, str(r.pub_date)) for r in store.read_store(spark, path).collect())
    assert days == [(1, "2018-08-02"), (2, "2018-08-02"), (3, "2018-08-03")]


def test_repair_rows(spark):
    fixes = spark.createDataFrame([(1, "author", "Ani"), (1, "content", "isi"), (2, "author", "Budi")], "id long, column string, new_value string")
    wide = {r.id: (r.author, r.content) for r in repair.widen(fixes, ["author", "content"]).collect()}
    assert wide == {1: ("Ani", "isi"), 2: ("Budi", None)}
    stored = spark.createDataFrame([(1, "", ""), (2, "x", "lama"), (3, "y", "z")], "id long, author string, content string")
    merged = repair.merge(stored, repair.widen(fixes, ["author", "content"]), "id", ["author", "content"])
    assert {r.id: (r.author, r.content) for r in merged.collect()} == {1: ("Ani", "isi"), 2: ("Budi", "lama"), 3: ("y", "z")}


def test_dump(spark, tmp_path):
    rows = spark.createDataFrame([(30, 'kata "kutip", koma\nbaris'), (10, "a"), (20_005, ""), (20_006, None)], "id long, text string")
    path = str(tmp_path / "dump")
    store.write_dump(rows, path, "id")
    back = store.read_dump(spark, path, "_index int, id long, text string")
    want = [(0, 10, "a"), (1, 30, 'kata "kutip", koma\nbaris'), (2, 20_005, ""), (3, 20_006, None)]
    assert sorted((r._index, r.id, r.text) for r in back.collect()) == want


def test_broken_dump(spark):
    cells = [
        (0, "{'id': 7, 'title': 'Judul', 'url': 'http://l/7', 'source': 'Liputan6', 'comments': 6, 'image': 'g.png', 'pubdate': '2018-07-30 23:15:00', 'content': 'isi \"x\"'}"),
        (1, "{'id': 8, 'url': 'http://l/8', 'content': 'rusak \\xa0 di sini"),
        (2, "False"),
    ]
    rescued, rest = store.rescue_dump(spark.createDataFrame(cells, "k int, cell string"), "cell")
    row = rescued.collect()
    assert len(row) == 1
    assert (row[0].post_id, row[0].images, row[0].comments, row[0].content, row[0].pubdate) == (7, "g.png", 6, 'isi "x"', dt.datetime(2018, 7, 30, 23, 15))
    assert sorted(r.k for r in rest.collect()) == [1, 2]


def test_run_state(spark, tmp_path):
    path = str(tmp_path / "state")
    shape = "site string, category string, end_date date, start_date date, page int, written_at timestamp"
    for page, hour in ((1, 1), (5, 3), (3, 2)):
        row = ("antara", "", dt.date(2018, 8, 1), dt.date(2018, 1, 1), page, dt.datetime(2018, 9, 1, hour))
        store.save_run_state(spark.createDataFrame([row], shape), path)
    last = store.latest_run_state(spark.read.parquet(path)).collect()
    assert [(r.site, r.page) for r in last] == [("antara", 5)]


def page(k, url, body="isi", hour=1):
    html = (
        f'<div class="breadcrumb"><a>H</a><a>Berita</a></div><article><span class="date">Rabu, 1 Agu 2018 0{hour}:00</span>'
        f'<div class="detail_text">{body}</div></article>'
    )
    return (k, url, html, dt.datetime(2018, 9, 1, hour))


def test_stream(spark, tmp_path):
    pages, path, checkpoint = (str(tmp_path / n) for n in ("pages", "store", "checkpoint"))
    rules = site_rules(spark)

    def arrive(*rows):
        spark.createDataFrame(list(rows), ingest.FETCHED).write.mode("append").parquet(pages)

    def run():
        query = ingest.ingest(spark, pages, path, checkpoint, rules)
        assert query.awaitTermination(240)
        return sorted(r.url for r in store.read_store(spark, path).collect())

    first = ["https://news.detik.com/1", "https://news.detik.com/2"]
    arrive(page(1, first[0]), page(2, first[1]), page(3, first[0] + "?page=all"), page(4, "https://unknown.org/1"))
    assert run() == first
    assert run() == first
    arrive(page(5, first[1] + "#x", hour=2), page(6, "https://inet.detik.com/3", hour=2))
    assert run() == sorted([*first, "https://inet.detik.com/3"])
    assert {r.category for r in store.read_store(spark, path).collect()} == {""}
    # The same pages under a lost checkpoint are stored already.
    query = ingest.ingest(spark, pages, path, str(tmp_path / "other"), rules)
    assert query.awaitTermination(240)
    assert store.read_store(spark, path).count() == 3


def test_stream_dedupe_within_the_watermark(spark, tmp_path):
    pages = str(tmp_path / "pages")
    # Equal copies go; an old page and another markup of an address stay.
    rows = [page(1, "http://a/1"), page(2, "http://a/1#x"), page(3, "http://a/2", hour=3), page(4, "http://a/2", "lain", hour=4)]
    rows.append((*page(5, "http://a/5")[:3], dt.datetime(2018, 8, 1)))
    spark.createDataFrame(rows, ingest.FETCHED).write.parquet(pages)
    distinct = ingest.distinct_pages(ingest.read_page_stream(spark, pages), "12 hours")
    query = (
        distinct.writeStream.format("memory").queryName("distinct_pages")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    assert query.awaitTermination(120)
    assert sorted(r.url_key for r in spark.table("distinct_pages").collect()) == ["http://a/1", "http://a/2", "http://a/2", "http://a/5"]


def test_pages_carry_their_links(spark, tmp_path):
    path = str(tmp_path / "store")
    found = spark.createDataFrame(
        [("https://news.detik.com/1#top", "news"), ("https://news.detik.com/1", "news"), ("https://x/9", "x")], "link string, category string"
    )
    pages = spark.createDataFrame([page(1, "https://news.detik.com/1"), page(2, "https://news.detik.com/2")], ingest.FETCHED)
    ingest.load_batch(pages, site_rules(spark), path, found)
    assert sorted((r.url[-1], r.category) for r in store.read_store(spark, path).collect()) == [("1", "news"), ("2", "")]


def test_repair_of_page_copies(spark, tmp_path):
    path = str(tmp_path / "store")
    rules = site_rules(spark)
    pages = spark.createDataFrame(
        [page(1, "https://news.detik.com/1"), page(2, "https://news.detik.com/1?page=all", "lain"), page(3, "https://news.detik.com/2")],
        ingest.FETCHED,
    )
    ingest.load_batch(pages, rules, path)
    rows = store.read_store(spark, path)
    wanted = repair.candidates(rows, F.col("url").endswith("/1"), ["url_key"])
    fixes = repair.recompute(wanted, assign_site(pages), rules, ["content"])
    assert [r.content for r in fixes.collect()] == ["isi"]
    store.repair_partitions(rows, fixes.unionByName(fixes), path, ["content"])
    spark.catalog.refreshByPath(path)
    assert store.read_store(spark, path).count() == 2
