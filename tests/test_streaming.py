"""Streams with state per address, compaction between batches."""

import datetime as dt

from kliping.rules.sites import site_rules
from kliping.sources import keys, manifest, store
from kliping.streaming import ingest

from .test_store import page


def fetched(k, url, at, body="isi"):
    return (*page(k, url, body)[:3], at)


def test_copies_by_event_time_and_a_page_ten_days_old(spark, tmp_path):
    pages, checkpoint, out = (str(tmp_path / n) for n in ("pages", "checkpoint", "out"))

    def run(*rows):
        spark.createDataFrame(list(rows), ingest.FETCHED).coalesce(1).write.mode("append").parquet(pages)
        spark.conf.set(ingest.IDLE_BATCHES, "false")
        kept = ingest.pages_by_event_time(ingest.read_page_stream(spark, pages), dt.timedelta(hours=12))
        query = kept.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
        assert query.awaitTermination(200)
        return sorted(r.page_id for r in spark.read.parquet(out).collect())

    day = dt.datetime(2018, 9, 11)
    hour = dt.timedelta(hours=1)
    first = [fetched(1, "http://a/1", day), fetched(2, "http://a/1#x", day + hour), fetched(3, "http://a/1", day, "lain"), fetched(4, "http://a/2", day)]
    assert run(*first) == [1, 3, 4]
    # State outlives the run; a page ten days old is no copy and goes on, as does one fetched much later.
    again = run(
        fetched(5, "http://a/1", day + 11 * hour), fetched(6, "http://a/1", day - dt.timedelta(days=10)), fetched(7, "http://a/1", day + 40 * hour),
        fetched(8, "http://b/1", None), fetched(9, None, day),
    )
    assert again == [1, 3, 4, 6, 7, 8, 9]


def test_late_page_reaches_the_store(spark, tmp_path):
    pages, path, checkpoint = (str(tmp_path / n) for n in ("pages", "store", "checkpoint"))

    def run(*rows):
        spark.createDataFrame(list(rows), ingest.FETCHED).coalesce(1).write.mode("append").parquet(pages)
        query = ingest.ingest(spark, pages, path, checkpoint, site_rules(spark), delay=dt.timedelta(hours=6))
        assert query.awaitTermination(240)
        return sorted(r.url for r in store.read_store(spark, path).collect())

    now = dt.datetime(2018, 9, 11)
    assert run(fetched(1, "https://news.detik.com/1", now), fetched(2, "https://news.detik.com/1", now)) == ["https://news.detik.com/1"]
    late = fetched(3, "https://news.detik.com/2", now - dt.timedelta(days=10))
    assert run(late, fetched(4, "https://news.detik.com/1", now - dt.timedelta(days=10))) == ["https://news.detik.com/1", "https://news.detik.com/2"]


def test_batches_are_compacted_and_keys_read_once(spark, tmp_path, monkeypatch):
    path, rules, asked, real = str(tmp_path / "store"), site_rules(spark), [], keys.stored
    monkeypatch.setattr(keys, "stored", lambda *a, **k: asked.append(1) or real(*a, **k))
    for k in range(6):
        ingest.load_batch(spark.createDataFrame([page(k, f"https://news.detik.com/{k}")], ingest.FETCHED), rules, path)
    assert len(asked) == 6
    assert len(manifest.live(spark, path)) == 6 and store.compact(spark, path) == 5
    assert len(manifest.live(spark, path)) == 1 and store.read_store(spark, path).count() == 6
