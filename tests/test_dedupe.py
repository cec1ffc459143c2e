"""New links, stop at first seen and load outcomes, against plain loops."""

import random
import re

import pytest
from pyspark.sql import functions as F

from kliping.operators import audit, dedupe, extract, filters, links
from kliping.plans import articles
from kliping.rules.listings import listing_rules
from kliping.rules.sites import site_rules


def like(pattern, text):
    parts = [".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern]
    return re.fullmatch("".join(parts), text, re.S) is not None


def test_wildcard_patterns(spark):
    rng = random.Random(5)
    words = ["berita", "oto_motif", "100%25", "a", "news", "x-y"]

    def url():
        return "http://" + rng.choice(["a.id/", "b_c.id/", "d.co.id/"]) + "/".join(rng.choice(words) for _ in range(rng.randint(1, 4)))

    incoming = [url() for _ in range(150)] + ["%", "_", "", "a%z", "%berita", "http://a.id/%/news", "http://a.id/_"]
    stored = [url().replace("_", rng.choice("_-x")) for _ in range(150)] + ["http://a.id/q", "abcz"]
    got = dedupe.new_links(
        spark.createDataFrame([(k, u) for k, u in enumerate(incoming)], "k int, url_key string"),
        spark.createDataFrame([(u,) for u in stored], "url_key string"),
        mode="like",
    )
    want = {k for k, u in enumerate(incoming) if not any(like(u, s) for s in stored)}
    assert {r.k for r in got.collect()} == want
    assert 0 < len(want) < len(incoming)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_equal_mode_takes_wildcards_literally(spark):
    links_df = spark.createDataFrame([("a_b",), ("acb",)], "url_key string")
    store = spark.createDataFrame([("acb",)], "url_key string")
    assert [r.url_key for r in dedupe.new_links(links_df, store).collect()] == ["a_b"]
    assert [r.url_key for r in dedupe.seen_links(links_df, store).collect()] == ["acb"]
    with pytest.raises(ValueError):
        dedupe.new_links(links_df, store, mode="other")


def run_listing(items, stored):
    """What reading one listing item by item would keep."""
    seen, kept = set(stored), []
    for place, key, ok in items:
        if key in seen:
            break
        kept.append(place)
        if ok:
            seen.add(key)
    return kept


def test_until_first_seen(spark):
    rng = random.Random(11)
    rows, want = [], set()
    stored = ["u1", "u7"]
    for site in range(40):
        items = [((p, n), f"u{rng.randint(0, 40)}", rng.random() < 0.7) for p in range(1, 4) for n in range(5)]
        rows += [(site, p, n, key, ok) for (p, n), key, ok in items]
        want |= {(site, *place) for place in run_listing(items, stored)}
    df = spark.createDataFrame(rows, "site int, page int, pos int, url_key string, ok boolean")
    store = spark.createDataFrame([(u,) for u in stored], "url_key string")
    got = dedupe.until_first_seen(df, store, ["site"], ["page", "pos"], accepted=F.col("ok"))
    assert {(r.site, r.page, r.pos) for r in got.collect()} == want


def test_rejected_copy_does_not_stop(spark):
    rows = [("s", 1, "a", False), ("s", 2, "a", True), ("s", 3, "b", True), ("s", 4, "a", True), ("s", 5, "c", True)]
    df = spark.createDataFrame(rows, "site string, pos int, url_key string, ok boolean")
    empty = spark.createDataFrame([], "url_key string")
    got = dedupe.until_first_seen(df, empty, ["site"], ["pos"], accepted=F.col("ok"))
    assert sorted(r.pos for r in got.collect()) == [1, 2, 3]


def test_each_site_has_its_habit(spark):
    rows = [(site, pos, key) for site in ("oto", "detik") for pos, key in enumerate("abcd")]
    found = spark.createDataFrame(rows, "site string, pos int, url_key string")
    store = spark.createDataFrame([("b",)], "url_key string")
    got = articles.unseen_links(found, store, listing_rules(spark), ["site"], ["pos"])
    assert sorted((r.site, r.url_key) for r in got.collect()) == [("detik", "a"), ("detik", "c"), ("detik", "d"), ("oto", "a")]


def test_first_by_key_with_a_hot_key(spark):
    rows = spark.range(20000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("url_key"))
    first = dedupe.first_by_key(rows.repartition(8), "url_key", ["id"])
    assert first.count() == 20000 - 6666
    assert first.filter("url_key = 0").collect() == [first.filter("url_key = 0").first()]
    assert first.filter("url_key = 0").first().id == 0
    plan = first._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before


def test_outcomes(spark):
    rows = [(1, "a", "no_body"), (2, "a", None), (3, "a", None), (4, "b", None), (5, "c", None)]
    batch = spark.createDataFrame(rows, "id int, url_key string, reject_reason string")
    store = spark.createDataFrame([("b",)], "url_key string")
    got = {r.id: r.outcome for r in dedupe.load_outcome(batch, store, "id", ["id"]).collect()}
    assert got == {1: "rejected", 2: "inserted", 3: "duplicate", 4: "duplicate", 5: "inserted"}


def test_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "url_key string")
    assert {r.url_key: r.n for r in dedupe.url_counts(df).collect()} == {"a": 2, "b": 1}


def test_filters(spark):
    df = spark.createDataFrame(
        [(1, "detikFOTO", "http://x/foto/1"), (2, None, "http://x/fotografi/2"), (3, "Berita", "http://x/video/3")],
        "k int, badge string, url string",
    )
    assert [r.k for r in filters.drop_badges(df, "badge").collect()] == [2, 3]
    assert [r.k for r in links.filter_segments(df, "url", ["foto", "video"]).collect()] == [2]
    kept, rejected = filters.quarantine(df, {"badge": F.col("badge").isNotNull(), "plain": ~F.col("url").contains("video")})
    assert [r.k for r in kept.collect()] == [1]
    assert {r.k: r.reject_reason for r in rejected.collect()} == {2: "badge", 3: "plain"}
    same = links.canonical_url(F.col("url"))
    urls = spark.createDataFrame([("http://t/1?page=all",), ("http://t/1/#top",), ("http://t/1",)], "url string")
    assert urls.select(same.alias("k")).distinct().count() == 1
    kept = spark.createDataFrame([("http://t/?p=1",), ("http://t/?p=2&page=all",), ("http://t/?p=2",)], "url string")
    assert sorted(r.k for r in kept.select(same.alias("k")).distinct().collect()) == ["http://t/?p=1", "http://t/?p=2"]


def test_seen_in_another_listing_of_the_run(spark):
    rows = [("a", 1, "u", True), ("a", 2, "v", False), ("b", 3, "w", True), ("b", 4, "u", True), ("b", 5, "x", True), ("c", 6, "v", True)]
    df = spark.createDataFrame(rows, "site string, pos int, url_key string, ok boolean")
    empty = spark.createDataFrame([], "url_key string")
    alone = dedupe.until_first_seen(df, empty, ["site"], ["pos"], accepted=F.col("ok"))
    assert alone.count() == 6
    run = dedupe.until_first_seen(df, empty, ["site"], ["pos"], accepted=F.col("ok"), run_order=["pos"])
    assert sorted(r.pos for r in run.collect()) == [1, 2, 3, 6]


def test_escapes_in_patterns(spark):
    patterns = [r"http://long.host.site.id/back\_slash_z", r"http://long.host.site.id/a%z", r"http://long.host.site.id/100\%", "http://plain"]
    stored = ["http://long.host.site.id/back_slashXz", "http://long.host.site.id/b-z", "http://long.host.site.id/100%", "http://plain"]
    links_ = spark.createDataFrame([(p,) for p in patterns], "url_key string")
    got = dedupe.new_links(links_, spark.createDataFrame([(s,) for s in stored], "url_key string"), mode="like")
    assert [r.url_key for r in got.collect()] == [patterns[1]]


def test_latest_n_of_a_hot_source(spark):
    rows = spark.range(9000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("source")).repartition(6)
    got = audit.latest_n(rows, "source", 1500, [F.desc("id")]).collect()
    assert sorted(r.id for r in got if r.source == "hot") == list(range(4500, 9000, 3))
    assert {(r.id, r.rank) for r in got if r.rank == 1} == {(8997, 1), (8999, 1)}


def test_pages_without_rules_are_reported(spark):
    pages = spark.createDataFrame([(1, "nowhere", "http://n/1", "<p>x</p>"), (2, "detik", "http://d/2", "<p>y</p>")], "page_id int, site string, url string, html string")
    got = {r.page_id: r.reject_reason for r in extract.extract_fields(pages, site_rules(spark)).collect()}
    assert got[1] == "no_rules" and got[2] not in (None, "no_rules")


def run_listings(items, stored):
    """What a run that reads all listings link by link would keep: items are (turn, listing, key, accepted)."""
    seen, closed, kept = set(stored), set(), set()
    for turn, listing, key, ok in sorted(items, key=lambda x: x[0]):
        if listing in closed:
            continue
        if key in seen:
            closed.add(listing)
            continue
        kept.add(turn)
        if ok and key is not None:
            seen.add(key)
    return kept


@pytest.mark.parametrize("seed", range(6))
def test_a_run_is_read_link_by_link(spark, seed):
    rng = random.Random(seed)
    listings = [(f"s{n % 3}", None if n % 4 == 0 else f"c{n}") for n in range(9)]
    # Long chains: a listing's stop often hangs on that of the one before it.
    items, turn = [], 0
    for listing in listings * (2 if seed % 2 else 1):
        for _ in range(rng.randint(1, 9)):
            turn += 1
            items.append((turn, listing, rng.choice([None, *(f"u{k}" for k in range(14 if seed < 3 else 30))]), rng.random() < 0.8))
    rng.shuffle(items)
    stored = ["u3", "u5"]
    df = spark.createDataFrame([(*x[1], x[0], x[2], x[3]) for x in items], "site string, category string, turn int, url_key string, ok boolean")
    store = spark.createDataFrame([(u,) for u in stored] + [(None,)], "url_key string")
    got = dedupe.until_first_seen(df, store, ["site", "category"], ["turn"], accepted=F.col("ok"), run_order=["turn"])
    assert {r.turn for r in got.collect()} == run_listings(items, stored)
    assert got.columns == df.columns


def test_chain_of_listings_settles(spark):
    """Each listing would be stopped by the one before it, if that one came to its second link."""
    rows = [(f"l{n:02}", 2 * n + p, key) for n in range(12) for p, key in enumerate((f"k{n}", f"k{n + 1}"))]
    df = spark.createDataFrame(rows, "site string, turn int, url_key string")
    for stored in ([], ["k0"], ["k1"], ["k5"]):
        store = spark.createDataFrame([(k,) for k in stored], "url_key string")
        got = dedupe.until_first_seen(df, store, ["site"], ["turn"], run_order=["turn"])
        assert {r.turn for r in got.collect()} == run_listings([(t, s, k, True) for s, t, k in rows], stored)


def test_run_order_reaches_the_sites(spark):
    # Category b comes to an address that category a has taken; a site without rules keeps its links.
    rows = [("rumah", "a", 1, "u"), ("rumah", "b", 2, "v"), ("rumah", "b", 3, "u"), ("rumah", "b", 4, "w"), ("unheard", "x", 5, "u"), ("unheard", "x", 6, "s")]
    found = spark.createDataFrame(rows, "site string, category string, turn int, url_key string")
    store = spark.createDataFrame([("s",)], "url_key string")
    got = articles.unseen_links(found, store, listing_rules(spark), ["site", "category"], ["turn"], run_order=["turn"])
    assert sorted(r.turn for r in got.collect()) == [1, 2, 5]
    assert got.columns == found.columns


def test_one_pair_of_categories_a_page(spark):
    pages = spark.createDataFrame([(1, "http://a/1", None), (2, "http://a/2", "own")], "page_id int, url string, category string")
    found = spark.createDataFrame(
        [("http://a/1", "mobil", "z", 2), ("http://a/1", "motor", "a", 1), ("http://a/1", None, None, 0), ("http://a/9", "x", "y", 1)],
        "link string, category string, subcategory string, at int",
    )
    by_order = {r.page_id: (r.category, r.subcategory) for r in links.pages_with_links(pages, found, order=["at"]).collect()}
    assert by_order == {1: ("motor", "a"), 2: ("own", None)}
    smallest = {r.page_id: (r.category, r.subcategory) for r in links.pages_with_links(pages, found).collect()}
    assert smallest == {1: ("mobil", "z"), 2: ("own", None)}


def test_a_thousand_patterns_of_one_host(spark, monkeypatch):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(60)]
    host = "http://www.host.co.id/berita/"
    stored = sorted({host + "-".join(rng.choices(words, k=rng.randint(2, 4))) for _ in range(1500)})
    patterns = []
    for _ in range(1000):
        text = list(rng.choice(stored))
        for _ in range(rng.randint(1, 3)):
            text[rng.randrange(len(text))] = rng.choice("_%__x")
        patterns.append("".join(text))
    patterns += ["%", "%ab", "_" * 40, "zz%", host + "%", "%" + stored[0][-6:], stored[5], None]
    monkeypatch.setattr(dedupe, "PER_BLOCK", 100)
    df = spark.createDataFrame(list(enumerate(patterns)), "k int, url_key string")
    got = dedupe.new_links(df, spark.createDataFrame([(s,) for s in stored] + [(None,)], "url_key string"), mode="like")
    exact = [re.compile("".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in p or ""), re.S) for p in patterns]
    want = {k for k, p in enumerate(patterns) if p is None or not any(exact[k].fullmatch(s) for s in stored)}
    assert {r.k for r in got.collect()} == want and 50 < len(want) < 950
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
