"""The language model against plain loops over restaurants, its sampler against one that seats every customer, and its probabilities' sum."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kliping.llm import language_model as M

def held():
    return F.col("doc_id") % 5 == 1


def _held(i):
    return i is not None and i % 5 == 1


def _seat(customers, opening, discount, key, sweep):
    tables = min(customers, 1)
    for k in range(1, customers):
        tables += M.uniform(np.array([key]), sweep, k)[0] * (opening + k - discount * tables) < opening
    return int(tables)


def _pair_key(a, b):
    return int(M.pair_key(np.array([a]), np.array([b]))[0])


class Plain:
    """The whole model in dictionaries; counts stay below ``STEPS``, so that every customer is drawn."""

    def __init__(self, rows, tasks=1):
        texts = [(i, [*M.words(t), M.END]) for i, t in rows]
        learned = [t for i, t in texts if not _held(i)]
        self.c = Counter(w for t in learned for w in t)
        vocabulary = sorted({w for _, t in texts for w in t}, key=lambda w: (-self.c[w], w))
        self.number = {w: k for k, w in enumerate(vocabulary)}
        self.pairs = Counter(p for t in learned for p in zip([M.END, *t[:-1]], t, strict=True))
        self.total, self.known = sum(self.c.values()), len(self.c)
        twos = Counter(self.pairs.values())
        ones = Counter(self.c.values())
        self.d, self.d0 = M.discount(twos[1], twos[2]), M.discount(ones[1], ones[2])
        tables = {p: 1 for p in self.pairs}
        root_tables, states = self.known, []
        for sweep in range(M.BURN + M.SAMPLES + 1):
            if sweep:
                tables = {
                    (a, b): _seat(n, (M.STRENGTH + self.d * states[-1]["tables"][a]) * self.root(states[-1], b), self.d, _pair_key(self.number[a], self.number[b]), sweep)
                    for (a, b), n in self.pairs.items()
                }
            dishes, context = Counter(), Counter()
            for (a, b), t in tables.items():
                dishes[b] += t
                context[a] += t
            opening = (M.ROOT_STRENGTH + self.d0 * root_tables) / (self.known + 1)
            root = {w: _seat(n, opening, self.d0, _pair_key(self.number[w], self.number[w]), -1 - sweep) for w, n in dishes.items()}
            root_tables = sum(root.values())
            states.append({"pairs": tables, "tables": context, "dishes": dishes, "root": root})
        self.states = states[M.BURN + 1 :]
        self.customers = Counter()
        for (a, _), n in self.pairs.items():
            self.customers[a] += n

    def root(self, state, word):
        opening = (M.ROOT_STRENGTH + self.d0 * sum(state["root"].values())) / (self.known + 1)
        mass = state["dishes"].get(word, 0) - self.d0 * state["root"].get(word, 0)
        return (mass + opening) / (M.ROOT_STRENGTH + sum(state["dishes"].values()))

    def probability(self, a, b):
        return sum(
            (self.pairs[a, b] - self.d * s["pairs"].get((a, b), 0) + (M.STRENGTH + self.d * s["tables"][a]) * self.root(s, b))
            / (M.STRENGTH + self.customers[a])
            for s in self.states
        ) / len(self.states)

    def score(self, text):
        t = [*M.words(text), M.END]
        base = sum(math.log10((self.c[w] + 0.5) / (self.total + 0.5 * (self.known + 1))) for w in t)
        return len(t), sum(self.c[w] > 0 for w in t), base, sum(math.log10(self.probability(a, b)) for a, b in zip([M.END, *t[:-1]], t, strict=True))


def texts():
    rng = random.Random(9)
    names = [f"w{k}" for k in range(120)]
    rows = [(i, " ".join(rng.choice(names[: rng.randint(1, 120)]) + rng.choice(["", "", "X"]) for _ in range(rng.randint(0, 25)))) for i in range(25)]
    return rows + [(25, None), (26, ""), (31, None), (None, "W1 w2\tnew"), (None, None), (3, rows[3][1]), (3, rows[3][1]), (41, "never heard ü𝄞"), (30, "ü𝄞 " * 5)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in texts()], "doc_id long, text string, id string, held string").repartition(3).cache()


@pytest.mark.parametrize("sizes", [{}, {"slice_tokens": 40, "block_tokens": 90}])
def test_scores(spark, frame, sizes):
    model = Plain(texts())
    assert max(model.pairs.values()) < M.STEPS and max(Counter(b for _, b in model.pairs).values()) < M.STEPS
    want = sorted(((i, _held(i), *model.score(t)) for i, t in texts()), key=repr)
    got = sorted((tuple(r) for r in M.scored(frame, held(), **sizes).collect()), key=lambda r: repr((r[0], r[1], r[2], r[3])))
    assert len(got) == len(want)
    for r, w in zip(sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[5])), sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[4])), strict=True):
        assert r[:4] == w[:4] and r[4] == model.total
        assert r[5] == pytest.approx(w[4], rel=1e-9) and r[6] == pytest.approx(w[5], rel=1e-5)


def test_probabilities_sum_to_one(spark):
    model = Plain(texts())
    for context in (M.END, b"w3", b"w77", b"nothing like it"):
        learned = sum(model.probability(context, w) for w in model.c)
        unknown = model.probability(context, b"unknown")
        assert learned + unknown == pytest.approx(1)


def test_several_word_tasks_change_numbers_only(spark, frame):
    one = {r.id: r for r in M.scored(frame, held()).collect() if r.id is not None}
    many = {r.id: r for r in M.scored(frame, held(), vocabulary_words=30, slice_tokens=60).collect() if r.id is not None}
    for i, r in one.items():
        assert (r.n_tokens, r.n_known, r.held_out, r.train_tokens) == (many[i].n_tokens, many[i].n_known, many[i].held_out, many[i].train_tokens)
        assert r.base_score == pytest.approx(many[i].base_score) and r.score == pytest.approx(many[i].score, rel=0.1)


def test_nothing_learned_and_empty(spark, frame):
    got = M.scored(frame, F.lit(True)).collect()
    assert all(r.score == r.base_score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in got) and len(got) == len(texts())
    assert M.scored(frame.filter("doc_id < 0"), held()).count() == 0


def test_thinning_seats_as_single_customers_do(monkeypatch):
    monkeypatch.setattr(M, "STEPS", 8)
    n, size = 3000, 400
    for opening, discount in ((0.5, 0.7), (8.0, 0.3), (60.0, 0.9)):
        keys = np.arange(n) * 7919
        fast = M.seat(np.full(n, size), np.full(n, opening), discount, keys, 3)
        rng = np.random.default_rng(0)
        slow = np.ones(n)
        for k in range(1, size):
            slow += rng.random(n) * (opening + k - discount * slow) < opening
        error = math.sqrt(fast.var() / n + slow.var() / n)
        assert abs(fast.mean() - slow.mean()) < 4.5 * error and abs(fast.std() / slow.std() - 1) < 0.15
    assert M.seat(np.array([0, 1, 10**9]), np.array([1.0, 1.0, 0.01]), 0.5, np.arange(3), 1).tolist()[:2] == [0, 1]


def test_held_out_texts_are_foreseen_better_than_by_counts(spark):
    rng = random.Random(2)
    follow = {k: [rng.randrange(60) for _ in range(3)] for k in range(60)}

    def text():
        out = [rng.randrange(60)]
        for _ in range(40):
            out.append(rng.choice(follow[out[-1]]))
        return " ".join(f"w{k}" for k in out)

    docs = spark.createDataFrame([(i, text()) for i in range(200)], "doc_id long, text string")
    sums = M.scored(docs, held()).filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert 10 ** (-sums[0] / sums[2]) < 8 < 40 < 10 ** (-sums[1] / sums[2])  # perplexities
