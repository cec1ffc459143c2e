"""Line dedup, near-duplicates and repeated byte strings against plain loops; components; SQL twins."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kliping.llm import graph, line_dedup, near_dedup, substring_dedup

from .conftest import as_set


def _roots(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 130)] + [(0, i) for i in range(1, 40)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    edges += [(500, 500)]
    got = graph.components(spark.createDataFrame(edges, "a long, b long"))
    assert dict(map(tuple, got.collect())) == _roots([e for e in edges if e[0] != e[1]])
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _key(i):
    return (i is not None, i or 0)


def test_line_dedup(spark, docs, none, rows):
    run = "first line\n second line \nthird line\n"
    extra = [(2000, run + "own"), (2001, "x\n" + run + "\n" + "y"), (2002, "first line\n\nsecond line\nthird line\r"), (2003, "z\nz\nz\nz\nz"), (2004, run * 2)]
    frame = docs.select("doc_id", "text", "id").unionByName(spark.createDataFrame([(*e, "q") for e in extra], "doc_id long, text string, id string"))
    texts = [(i, t) for i, t, _ in rows] + extra
    windows = []  # window, order
    cut = {}
    for i, t in {(i, t) for i, t in texts if t is not None}:
        lines = t.split("\n")
        full = [(n, x.strip(" \t\r")) for n, x in enumerate(lines) if x.strip(" \t\r")]
        for p in range(len(full) - 2):
            windows.append((tuple(x for _, x in full[p : p + 3]), _key(i), p, i, t, [n for n, _ in full[p : p + 3]]))
    first = {}
    digest = {t: spark.range(1).select(F.xxhash64(F.lit(t))).first()[0] for _, t in texts if t is not None}
    for w, k, p, _, t, _ in windows:
        first[w] = min(first.get(w, (k, digest[t], p)), (k, digest[t], p))
    for w, k, p, i, t, numbers in windows:
        if (k, digest[t], p) > first[w]:
            cut.setdefault((i, t), set()).update(numbers)
    want = []
    for i, t in texts:
        lost = cut.get((i, t), set())
        want.append((i, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in lost), len(lost)))
    marked, lost = line_dedup.marked(frame)
    got = marked.select("doc_id", line_dedup.kept_text(F.col("text"), lost), F.size(lost), "id")
    assert as_set(got.drop("id"), "*") == sorted(want, key=repr)
    assert line_dedup.marked(none)[0].count() == 0
    gone = {r.doc_id for r in marked.filter(line_dedup.depleted(F.col("text"), lost)).collect()}
    assert 2002 in gone and 2000 not in gone and 1000 not in gone


def _sets(texts, size):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append(frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) or frozenset([tuple(w)] if w else []))
    return out


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates(docs, none, rows, size):
    sets = _sets([r[1] for r in rows], size)
    edges = [(k, k) for k in range(len(rows))]
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                edges.append((b, a))
    roots = _roots(edges)
    least = {}
    for k, r in roots.items():
        i = rows[k][0]
        if i is not None:
            least[r] = min(least.get(r, i), i)
    want = [(rows[k][0], len(sets[k]), least.get(r), rows[k][0] == least.get(r)) for k, r in roots.items()]
    assert as_set(near_dedup.grouped(docs, shingle=size), "id", "n_shingles", "component_id", "kept") == sorted(want, key=repr)
    if size == 5:
        kept = near_dedup.representatives(docs)
        assert kept.columns == docs.columns and kept.count() == sum(w[3] for w in want)
        assert near_dedup.grouped(none).count() == 0


def test_many_variants_stay_one_group(spark):
    """A cluster of variants that link in chains, and heavier edits that link with none."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(150)]
    texts = []
    for k in range(160):
        words = list(base)
        for _ in range(k % 40 // 4):
            words[rng.randrange(150)] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    sets = _sets(texts, 4)
    edges = [(k, k) for k in range(160)]
    edges += [(b, a) for a in range(160) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = _roots(edges)
    got = near_dedup.grouped(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), shingle=4)
    assert {r.id: r.component_id for r in got.collect()} == want and len(set(want.values())) > 3


def test_repeated_strings(docs, none, rows):
    length = substring_dedup.LENGTH
    data = [(i, (t or "").encode()) for i, t, _ in rows]
    seen = Counter(d[s : s + length] for _, d in data for s in range(len(d) - length + 1))
    want = []
    for i, d in data:
        gone = np.zeros(len(d), bool)
        for s in range(len(d) - length + 1):
            if seen[d[s : s + length]] > 1:
                gone[s : s + length] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = hashlib.sha256(np.frombuffer(d, np.uint8)[~gone].tobytes()).hexdigest()
        want.append((i, len(d), int(gone.sum()), spans, kept))
    got = substring_dedup.repeated_spans(docs).withColumn("n_spans", F.size("spans"))
    assert as_set(got, "id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=repr)
    assert sum(w[2] > 0 for w in want) > 10 and any(0 < w[2] < w[1] for w in want)
    assert substring_dedup.repeated_spans(none).count() == 0


def _without_repeats(data, length=substring_dedup.LENGTH):
    seen = Counter(d[s : s + length] for d in data for s in range(len(d) - length + 1))
    for d in data:
        gone = np.zeros(len(d), bool)
        for s in range(len(d) - length + 1):
            if seen[d[s : s + length]] > 1:
                gone[s : s + length] = True
        yield int(gone.sum()), hashlib.sha256(np.frombuffer(d, np.uint8)[~gone].tobytes()).hexdigest()


def test_passages_near_the_ends_of_texts(spark):
    """A shared passage of 400 to 460 bytes that ends up to 300 bytes before either text's end, or starts near its beginning."""
    rng = random.Random(12)
    junk = lambda n: "".join(rng.choices("abcdefghij klmnop", k=n))
    texts = []
    for n in range(150):
        passage = junk(rng.randint(398, 460))
        texts += [junk(rng.choice([0, 3, 200, 900])) + passage + junk(rng.choice([0, 1, 20, rng.randint(0, 300)])) for _ in range(2)]
        if n % 10 == 0:
            texts.append(passage[:430] * 2)
            texts.append("ab" * 300 + junk(5))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    want = list(_without_repeats([t.encode() for t in texts]))
    for sizes in ({}, {"slice_bytes": 5000, "keys": 300}):
        got = {r.id: (r.n_removed, r.kept_sha256) for r in substring_dedup.repeated_spans(docs, **sizes).collect()}
        assert [got[k] for k in range(len(texts))] == want
    assert sum(n > 0 for n, _ in want) > 280


def test_slices_without_anchors_or_blocks(spark):
    """Slices that have nothing to compare, from the start or from some round on, beside slices that do."""
    rng = random.Random(3)
    junk = lambda n: "".join(rng.choices("abcdefghij klmnop", k=n))
    passage, whole = junk(700), junk(900)
    short, alone = ["", "one", None, junk(399)], [junk(400), junk(5000)]
    shared = [junk(300) + passage + junk(500), passage + junk(40), whole, whole]
    for texts in (short, alone, short + alone + shared):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
        want = list(_without_repeats([(t or "").encode() for t in texts]))
        for sizes in ({}, {"slice_bytes": 1, "keys": 5}):
            got = {r.id: (r.n_removed, r.kept_sha256) for r in substring_dedup.repeated_spans(docs, **sizes).collect()}
            assert [got[k] for k in range(len(texts))] == want
    assert sum(n > 0 for n, _ in want) == 4


def _words_in_passages(texts, size=substring_dedup.WORDS):
    """Words inside runs of ``size`` words that another text holds."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    held = Counter(w for x in words for w in {tuple(x[s : s + size]) for s in range(len(x) - size + 1)})
    for x in words:
        inside = set()
        for s in range(len(x) - size + 1):
            if held[tuple(x[s : s + size])] > 1:
                inside.update(range(s, s + size))
        yield len(inside)


def test_passages_of_words(spark):
    """Passages of over 50 words stay where they have fewer than 400 bytes, and are counted."""
    rng = random.Random(14)
    vocabulary = ["a", "an", "be", "Zoë", "über", "x" * 40, *(f"w{k}" for k in range(300))]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    texts = [None, "", "  \n", "one", prose(49), prose(50), prose(400)]
    for size in (49, 50, 51, 60, 73, 74, 90, 200):
        for _ in range(6):
            passage = " ".join(rng.choices(vocabulary[:5] + vocabulary[6:], k=size))
            texts += [prose(rng.choice([0, 1, 30, 200])) + gap + passage.replace(" ", gap) + " " + prose(rng.choice([0, 2, 80])) for gap in (" ", "\n\n")]
    texts += ["a " * 300, "a " * 120 + "b", prose(60) + " " + "c " * 70, texts[6], texts[5], texts[5] + "."]
    alone = prose(55)
    texts += [alone + " " + alone, "x" * 2000 + " " + "y" * 3000]  # repeats within one text only
    docs = spark.createDataFrame([(k % 90 or None, t) for k, t in enumerate(texts)], "doc_id long, text string")
    want = sorted(zip((len((t or "").encode()) for t in texts), _words_in_passages(texts), strict=True))
    assert sum(n > 0 for _, n in want) > 80 and want[-1] == (5001, 0)
    for sizes in ({}, {"slice_bytes": 5000, "keys": 300}):
        got = substring_dedup.repeated_spans(docs.repartition(3), **sizes).collect()
        assert sorted((r.n_bytes, r.n_passage_words) for r in got) == want
    kept = [r for r in got if r.n_passage_words > 50 and not r.n_removed]
    assert len(kept) > 20


def test_anchors_cover_all_starts():
    rng = random.Random(4)
    for data in (bytes(rng.choices(b"ab", k=3000)), b"z" * 2000, bytes(rng.choices(range(256), k=400)), b"z" * 399):
        at, first, last = substring_dedup.anchors(data)
        starts = [s for a, b in zip(first.tolist(), last.tolist(), strict=True) for s in range(a, b + 1)]
        assert starts == list(range(len(data) - 399))
        assert all(a <= p < b + 128 + 1 for p, a, b in zip(at.tolist(), last.tolist(), first.tolist(), strict=False))
