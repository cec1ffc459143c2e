"""The store's commits, key index, repairs and compaction, on real folders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kliping.sources import keys, manifest, store

from .test_store import SHAPE, article, batch, outcomes


def rows_of(spark, path):
    return sorted((r.post_id, r.source, str(r.pub_date), r.content) for r in store.read_store(spark, path).collect())


def undated(k, source):
    return (*article(k, f"http://x/{k}", source)[:3], None, *article(k, f"http://x/{k}", source)[4:])


def test_repairs_lose_no_row_without_source_or_date(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [article(1, "http://x/1", ""), article(2, "http://x/2", ""), article(3, "http://x/3", None), undated(4, ""), undated(5, None), undated(6, "a")]
    store.insert_if_absent(batch(spark, *rows), path, "row").count()
    before = rows_of_none(spark, path)
    assert [b[:2] for b in before] == [(1, ""), (2, ""), (3, None), (4, ""), (5, None), (6, "a")]
    fixes = spark.createDataFrame([("http://x/1", "baru"), ("http://x/4", "baru"), ("http://x/5", "baru")], "url_key string, content string")
    store.repair_partitions(store.read_store(spark, path), fixes, path, ["content"])
    after = rows_of_none(spark, path)
    assert [a[:3] for a in after] == [b[:3] for b in before]
    assert [a[3] for a in after] == ["baru", "isi", "isi", "baru", "baru", "isi"]
    moved = spark.createDataFrame([(f"http://x/{k}", dt.datetime(2018, 8, 9)) for k in (3, 4, 5)], "url_key string, pubdate timestamp")
    store.repair_partitions(store.read_store(spark, path), moved, path, ["pubdate"])
    last = rows_of_none(spark, path)
    assert [(a[0], a[1], a[3]) for a in last] == [(a[0], a[1], a[3]) for a in after]
    assert [a[2] for a in last] == ["2018-08-01", "2018-08-01", "2018-08-09", "2018-08-09", "2018-08-09", "None"]


def rows_of_none(spark, path):
    rows = store.read_store(spark, path).collect()
    return sorted(((r.post_id, r.source, str(r.pub_date), r.content) for r in rows), key=lambda r: r[0])


def test_a_repair_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    store.insert_if_absent(batch(spark, *[article(k, f"http://x/{k}", day=1 + k % 3) for k in range(9)]), path, "row").count()
    before = rows_of(spark, path)
    fixes = spark.createDataFrame([("http://x/1", "baru", dt.datetime(2018, 8, 20))], "url_key string, content string, pubdate timestamp")

    def killed(*args, **kwargs):
        raise KeyboardInterrupt

    commit = manifest.commit
    for step in ("write_files", "commit"):
        with monkeypatch.context() as patch:
            patch.setattr(*((store, step) if step == "write_files" else (manifest, step)), killed)
            with pytest.raises(KeyboardInterrupt):
                store.repair_partitions(store.read_store(spark, path), fixes, path, ["content", "pubdate"])
        assert rows_of(spark, path) == before
    # The files of the second try lie there, but no reader follows them; a writer that dies while inserting is no different.
    assert set(manifest.files_below(spark, path)) > set(manifest.live(spark, path))
    with monkeypatch.context() as patch:
        patch.setattr(manifest, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            store.insert_if_absent(batch(spark, article(50, "http://x/50")), path, "row")
    assert rows_of(spark, path) == before and manifest.commit is commit
    assert outcomes(store.insert_if_absent(batch(spark, article(50, "http://x/50")), path, "row")) == {50: "inserted"}
    store.repair_partitions(store.read_store(spark, path), fixes, path, ["content", "pubdate"])
    now = rows_of(spark, path)
    assert len(now) == 10 and (1, "detik", "2018-08-20", "baru") in now
    gone = manifest.vacuum(spark, path, 1 << 60)
    assert gone and rows_of(spark, path) == now and sorted(manifest.live(spark, path)) == manifest.files_below(spark, path)


def test_a_repair_reads_the_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [article(k, f"http://x/{k}", day=1 + k) for k in range(19)]
    store.insert_if_absent(batch(spark, *rows), path, "row").count()
    files = manifest.live(spark, path)
    assert len({f.rsplit("/", 1)[0] for f in files}) == 19
    read, real = [], store.read_files

    def spy(spark_, path_, wanted, *more):
        read.append(list(wanted))
        return real(spark_, path_, wanted, *more)

    found = store.read_store(spark, path)
    fixes = spark.createDataFrame([("http://x/7", "baru")], "url_key string, content string")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(store, "read_files", spy)
        store.repair_partitions(found, fixes, path, ["content"])
    assert [{f.rsplit("/", 1)[0] for f in r} for r in read] == [{"source=detik/pub_date=2018-08-08"}]
    text = real(spark, path, read[0])._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in text
    assert len(set(files) & set(manifest.live(spark, path))) == 18


def test_rows_without_address_are_rejected(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [article(1, None), article(2, ""), article(3, "http://x/3")]
    for want in ("inserted", "duplicate"):
        got = store.insert_if_absent(batch(spark, *rows), path, "row").collect()
        assert {r.row: (r.outcome, r.reject_reason) for r in got} == {1: ("rejected", "no_address"), 2: ("rejected", "no_address"), 3: (want, None)}
    assert store.read_store(spark, path).count() == 1


def test_key_index(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    monkeypatch.setattr(keys, "LITERALS", 5)
    many = [article(k, f"http://x/{k}") for k in range(40)]
    assert set(outcomes(store.insert_if_absent(batch(spark, *many[:20]), path, "row")).values()) == {"inserted"}
    # The index is behind by the commit before; repairs and compactions leave it as it is.
    store.repair_partitions(store.read_store(spark, path), spark.createDataFrame([("http://x/3", "b")], "url_key string, content string"), path, ["content"])
    again = outcomes(store.insert_if_absent(batch(spark, *many), path, "row"))
    assert {k for k, o in again.items() if o == "inserted"} == set(range(20, 40))
    store.append(store.with_keys(batch(spark, article(90, "http://x/90"))).select(*store.STORED.fieldNames()), path)
    wanted = spark.createDataFrame([("http://x/90",), ("http://x/91",), ("http://x/1",), (None,)], "url_key string")
    found = keys.stored(wanted, path)
    assert {r.url_key for r in found.collect()} == {"http://x/90", "http://x/1"}
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "In(url_key" in text or "url_key IN" in text or "OR" in text
    # A large batch is shuffled to the buckets; the index is not.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = spark.createDataFrame([(f"http://x/{k}",) for k in range(30, 60)], "url_key string")
        left = large.join(keys.stored(large, path), "url_key", "left_anti")
        text = left._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange") == 1 and "Bucketed: true" in text
        assert {r.url_key for r in left.collect()} == {f"http://x/{k}" for k in range(40, 60)}
        keys.rebuild(spark, path, buckets=8)
        assert {r.url_key for r in large.join(keys.stored(large, path), "url_key", "left_anti").collect()} == {f"http://x/{k}" for k in range(40, 60)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert outcomes(store.insert_if_absent(batch(spark, *many[:3], article(99, "http://x/99")), path, "row")) == {
        0: "duplicate", 1: "duplicate", 2: "duplicate", 99: "inserted",
    }


def test_two_writers_insert_an_address_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    store.insert_if_absent(batch(spark, article(1, "http://x/1")), path, "row").count()
    write, other = store.write_files, []

    def slow(rows, where):
        files = write(rows, where)
        if not other:
            other.append(True)
            assert outcomes(store.insert_if_absent(batch(spark, article(2, "http://x/2")), path, "row")) == {2: "inserted"}
        return files

    monkeypatch.setattr(store, "write_files", slow)
    got = store.insert_if_absent(batch(spark, article(3, "http://x/2"), article(4, "http://x/4")), path, "row")
    assert outcomes(got) == {3: "duplicate", 4: "inserted"}
    assert [r[0] for r in rows_of(spark, path)] == [1, 2, 4]
    with pytest.raises(manifest.Conflict):
        manifest.commit(spark, path, [], ["source=detik/pub_date=2018-08-01/nothing.parquet"])


def test_compaction(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    monkeypatch.setattr(manifest, "EVERY", 10)
    for k in range(30):
        rows = store.with_keys(batch(spark, article(k, f"http://x/{k}", source="" if k % 5 == 0 else "a", day=1 + k % 2)))
        store.append(rows.select(*store.STORED.fieldNames()), path)
    before, files = rows_of(spark, path), manifest.live(spark, path)
    assert len(files) == 30 and any(n.endswith(".sum") for n in manifest.names(spark, path, manifest.LOG))
    size = dict(manifest.sizes(spark, path, files))
    # Bins of about four files; every bin becomes at most one file.
    saved = store.compact(spark, path, file_bytes=4 * max(size.values()))
    left = manifest.live(spark, path)
    assert rows_of(spark, path) == before and len(left) == 30 - saved
    by_folder = {}
    for f in files:
        by_folder[f.rsplit("/", 1)[0]] = by_folder.get(f.rsplit("/", 1)[0], 0) + 1
    assert len(by_folder) == 4 and len(left) <= sum(-(-n // 4) + 1 for n in by_folder.values())
    assert store.compact(spark, path, small_bytes=1) == 0
    manifest.vacuum(spark, path, 1 << 60)
    assert rows_of(spark, path) == before
    assert outcomes(store.insert_if_absent(batch(spark, article(3, "http://x/3")), path, "row")) == {3: "duplicate"}


def test_folder_without_a_log_is_taken_over(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = store.with_keys(batch(spark, *[article(k, f"http://x/{k}") for k in range(4)])).select(*store.STORED.fieldNames())
    rows.write.partitionBy(*store.PARTITIONS).parquet(path)
    assert len(rows_of(spark, path)) == 4
    assert outcomes(store.insert_if_absent(batch(spark, article(2, "http://x/2"), article(9, "http://x/9")), path, "row")) == {2: "duplicate", 9: "inserted"}
    assert [r[0] for r in rows_of(spark, path)] == [0, 1, 2, 3, 9]
    store.overwrite_partitions(store.read_store(spark, path, F.col("post_id") > 1), path)
    assert [r[0] for r in rows_of(spark, path)] == [2, 3, 9]
    assert SHAPE
