"""What operators do beyond the thin queries: short runs of long lines, one row of each group, decoded pieces, near phrases between neighbours."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kliping.llm import decontaminate, line_dedup, near_dedup, segmentation

from .conftest import as_set


def _cut(texts, run, words):
    """Brute force: the numbers of the lines that go, by id (unique, not null)."""
    seen, gone = set(), {}
    for i, t in sorted((i, t) for i, t in texts if t is not None):
        full = [(n, x.strip(" \t\r")) for n, x in enumerate(t.split("\n")) if x.strip(" \t\r")]
        for p in range(len(full)):
            for k in range(1, run + 1):
                part = full[p : p + k]
                if len(part) == k and (k == run or sum(len(x.replace("\t", " ").replace("\r", " ").split(" ")) for _, x in part) >= words):
                    window = tuple(x for _, x in part)
                    if window in seen:
                        gone.setdefault(i, set()).update(n for n, _ in part)
                    seen.add(window)
    return gone


def test_short_runs_of_many_words_go(spark):
    line = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    long, half, other = line("long", 30), line("half", 13), line("other", 12)
    texts = [
        (1, f"a one\n{long}\nb one"), (2, f"a two\n \n {long}\r\nb two"), (3, long), (4, f"{half}\n\n{other}\nc"),
        (5, f"d\n{half}\n{other}"), (6, f"{half}\ne\n{other}"), (7, "s\nt\nu"), (8, "s\nt\nv"), (9, "s\nt\nu\nv"),
        (10, f"{long}\n{long}"), (11, ""), (12, None), (13, line("long", 24)), (14, line("long", 24)),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    marked, lost = line_dedup.marked(docs, words=25)
    got = {r[0]: set(r[1]) for r in marked.select("doc_id", lost).collect() if r[1]}
    assert got == _cut(texts, 3, 25)
    assert got == {2: {2}, 3: {0}, 5: {1, 2}, 9: {0, 1, 2}, 10: {0, 1}}
    plain, lost = line_dedup.marked(docs)
    assert {r[0] for r in plain.select("doc_id", lost).collect() if r[1]} == {9}


def test_pipeline_cuts_short_runs(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(1, f"own\n{passage}", 1), (2, f"{passage}\nmore", 1)], "doc_id long, text string, n_chars long")
    got = corpus_pipeline.without_repeated_lines(spark, docs, "")
    assert as_set(got, "doc_id", F.col("text").substr(1, 4), "n_chars") == [(1, "own\n", 1), (2, "more", 4)]


def test_one_row_of_each_group_stays(spark, docs, none):
    text = lambda name, n=60: " ".join(f"{name}{k}" for k in range(n))
    a, b, c = text("a"), text("b"), text("c")
    rows = [
        (1, a, "x"), (1, a, "x"), (1, a, "y"), (2, a, "x"), (1, a + " more", "x"), (None, a, "x"),  # smallest id repeated, with two texts
        (None, b, "x"), (None, b, "x"), (None, b + " more", "x"), (None, b + " more", "x"),  # all ids null
        (7, c, "x"), (8, c + " more", "x"), (8, c + " more", "x"), (9, text("d"), "x"), (10, "", "x"), (11, None, "x"), (None, None, "x"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, id string").repartition(3)
    got = near_dedup.one_of_each(frame)
    assert got.columns == frame.columns
    kept = sorted(((r.doc_id, (r.text or "")[:1]) for r in got.collect()), key=repr)
    assert kept == sorted([(1, "a"), (None, "b"), (7, "c"), (9, "d"), (10, ""), (11, ""), (None, "")], key=repr)
    stage = corpus_pipeline.without_near_duplicates(spark, frame, "")
    assert stage.count() == len(kept)
    groups = near_dedup.grouped(docs).filter("n_shingles > 0")
    left = near_dedup.one_of_each(docs).filter("trim(translate(text, '\n\t\r', '   ')) <> ''")
    assert left.count() == groups.select(F.coalesce("component_id", F.xxhash64("digest"))).distinct().count()
    assert near_dedup.one_of_each(none).count() == 0


def test_pipeline_decodes(spark, docs, monkeypatch):
    got = corpus_pipeline.encoded(spark, docs, "")
    want = docs.select("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("crc"))
    assert set(as_set(got, "doc_id", "text_crc32")) == set(as_set(want, "doc_id", "crc"))
    assert got.filter("sample = 1").count() == docs.count()
    load = segmentation.Vocabulary.load

    def broken(*args):
        vocabulary = load(*args)
        vocabulary._bytes = [b"?"] * len(vocabulary.pieces)
        return vocabulary

    monkeypatch.setattr(segmentation.Vocabulary, "load", staticmethod(broken))
    with pytest.raises(Exception, match="does not decode to its text"):
        corpus_pipeline.encoded(spark, docs, "").collect()


def _near(texts, items):
    """Brute force: the items with a window whose rarest word is in the text and the others within SLACK of their places."""
    slack, split = decontaminate.SLACK, {i: decontaminate.words(t) for i, t in texts}
    counts = Counter(w for x in split.values() for w in x)
    out = {i: set() for i in split}
    for item, text in items:
        own = decontaminate.words(text)
        for a in range(max(1, len(own) - decontaminate.WINDOW + 1)):
            window = own[a : a + decontaminate.WINDOW]
            rare = min(range(len(window)), key=lambda k: counts[window[k]])
            for i, x in split.items():
                for s in (p - rare for p, w in enumerate(x) if w == window[rare]):
                    if all(k == rare or w in x[max(0, s + k - slack) : max(0, s + k + slack + 1)] for k, w in enumerate(window)):
                        out[i].add(item)
    return out


def test_near_phrases_stay_in_their_documents(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    texts = [
        (1, "x y z"), (2, "beta alpha gamma delta epsilon zeta eta theta kappa iota"), (3, ""),
        (4, "gamma alpha beta delta epsilon zeta eta theta iota kappa"), (5, "q alpha beta gamma delta epsilon"),
        (6, "zeta eta theta iota kappa"), (7, "kappa"), (8, item), (9, "beta gamma delta alpha epsilon zeta eta theta iota kappa alpha alpha"),
    ]
    rng = random.Random(6)
    for i in range(10, 90):
        own = item.split()
        for _ in range(rng.randrange(4)):
            k = rng.randrange(9)
            own[k : k + 2] = own[k : k + 2][::-1]
        cut = rng.choice([0, 0, 4])
        texts.append((i, " ".join(own[cut:] if rng.random() < 0.5 else own[: 10 - cut])))
    items = [("i", item), ("j", "epsilon zeta eta")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)  # neighbours in one segment
    found = decontaminate.search(docs, spark.createDataFrame(items, "item_id string, text string")).collect()
    got = {r.id: set(r.near) for r in found}
    assert got == _near(texts, items)
    assert "i" in got[2] and got[1] == got[3] == got[7] == set() and "i" not in got[5] | got[6]
    assert {r.id for r in found if "i" in r.items} >= {8}
