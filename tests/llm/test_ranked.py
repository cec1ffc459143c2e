"""Ranked search against scoring every document, and the Best Position Algorithm on single segments."""

import random
from collections import Counter

import numpy as np
import pytest

from kliping.llm import ranked_search
from kliping.llm.decontaminate import words

from .conftest import prose


def _all(rows, items, top):
    """Brute force: the sorted list of (-score, id) of each (item, text)."""
    docs = [(i, Counter(words(t))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    documents, total = len(docs), sum(n for _, _, n in docs)
    df = Counter(w for _, c, _ in docs for w in c)
    out = {}
    for item in set(items):
        own = []
        for i, c, n in docs:
            m = 50 + 50 * n * documents // total
            score = sum(ranked_search.weight(documents, df[w]) * (10**9 * c[w] // (1000 * c[w] + 20 * m)) for w in set(words(item[1])) if c[w])
            if score > 0:
                own.append((-score, i is not None, i or 0))
        out[item] = sorted(own)[:top]
    return out


def _items(rows):
    rng = random.Random(3)
    items = [(k, prose(rng, rng.randint(1, 40))) for k in range(25)]
    items += [(25, None), (26, ""), (27, "unheard"), (28, "ara ARA ara"), (28, "ara ARA ara"), (29, rows[0][1]), (30, "one two"), (None, "x1 ÜBER 𝄞")]
    return items + [(31, rows[40][1]), (32, " ".join(t for _, t, _ in rows[:30]))]


@pytest.mark.parametrize("top", [1, 7, 50])
def test_search_against_all_documents(spark, docs, rows, top, monkeypatch):
    items = _items(rows)
    monkeypatch.setattr(ranked_search, "SEGMENT_POSTINGS", 400)  # several segments a task
    frame = spark.createDataFrame([(*x, "q", 5) for x in items], "item_id long, text string, id string, rank int")
    got = ranked_search.search(docs, frame, top=top, block_terms=200 if top == 7 else ranked_search.BLOCK_TERMS).collect()
    for item, best in _all([r[:2] for r in rows], items, top).items():
        own = sorted((r.rank, r.score, r.doc_id) for r in got if r.item_id == item[0])
        assert [r for r, _, _ in own] == list(range(1, len(best) + 1))
        assert sorted((-s, i is not None, i or 0) for _, s, i in own) == best
        assert [s for _, s, _ in own] == [-b[0] for b in best]


def test_nothing_to_search(spark, docs, none):
    items = spark.createDataFrame([(1, "ara bel")], "item_id long, text string")
    empty = ranked_search.search(docs, items.filter("item_id < 0"))
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]
    assert ranked_search.search(none, items).count() == 0
    assert ranked_search.search(docs.filter("text = ''"), items).count() == 0


def test_items_sharing_an_id_are_ranked_apart(spark, docs):
    items = spark.createDataFrame([(1, "ara"), (1, "bel"), (1, "bel")], "item_id long, text string")
    got = ranked_search.search(docs, items, top=3).collect()
    assert sorted(r.rank for r in got) == [1, 1, 2, 2, 3, 3]


def test_best_positions_stop_early_and_miss_nothing():
    rng = np.random.default_rng(1)
    n = 20_000
    postings = [(np.full(len(d), t), d) for t in range(6) for d in [rng.choice(n, rng.integers(10, n), replace=False)]]
    term, doc = (np.concatenate(x) for x in zip(*postings, strict=True))
    # A document's impacts go together, as those of short texts do.
    impact = (1000 * rng.exponential(1, n)[doc] ** 3 * (1 + rng.random(len(doc)) / 10)).astype(np.int64) + 1
    segment = ranked_search.Segment(term, doc, impact, n)
    for query in ([0], [1, 2], [0, 1, 2, 3, 4, 5], [3, 99], [99]):
        docs, scores, read = segment.best(np.array(query), 20)
        total = np.zeros(n, np.int64)
        for t in query:
            np.add.at(total, doc[term == t], impact[term == t])
        assert np.array_equal(total[docs], scores) and len(set(docs.tolist())) == len(docs)
        if query != [99]:
            limit = np.sort(total)[-20]
            assert set(np.flatnonzero(total >= limit).tolist()) <= set(docs.tolist())
            assert read < n // 4
    # Equal scores everywhere: nothing may be cut.
    flat = ranked_search.Segment(np.zeros(500, int), np.arange(500), np.full(500, 7), 500)
    assert len(flat.best(np.array([0]), 5)[0]) == 500
