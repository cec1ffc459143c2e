"""Toxicity by a weighted finite-state grammar over clauses.

Words and phrases of a clause become symbols, and a machine composed of three state
tables reads them. The insult lexicon accepts word beginnings and whole words; its
weights are log odds learned from labelled documents, so it learns stems that
inflect. The threat lexicon is a trie of words and phrases (fixed values below); each weighs as much as the
labelled documents show, 1 where they do not tell. The tables are transducers, symbols in and symbols
out: negation counts down over the ``SCOPE`` words behind it and marks insults and threats there,
reported speech marks those in the rest of its clause, and the target table
remembers whether anyone is addressed. Composing them gives one table of the reachable states, and
each insult or threat leaves it under one of twelve labels: kind, scope, and whether its clause has a target.
A clause without insult or threat matches nothing, whatever other words it has.

A document's features are, per label, the total weight that left under it, the strongest clause, and the
number and share of matched clauses. A logistic regression learns a weight for each.

Fitting takes at most ``PER_LABEL`` documents of each label, those with the
smallest id hashes, and leaves out every row that the caller holds out.
A pattern's log odds, less ``SURE`` standard errors, must reach ``LEAST_ODDS``.
Only patterns and features reach the driver, never texts; the sample bounds their number.

Very long texts are read whole, clause by clause. Ties: a document on the threshold is toxic.
Null and empty texts match nothing and get the score of such texts; repeated
rows get equal rows; without labels every score is 0. Repeated labels of an id
count as toxic if one is. Extra columns are ignored by ``scored`` and kept by
``without_toxic``; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kliping.llm.shared import SLICE, in_small_batches, map_slices, released, schema_of, slices_of

PER_LABEL = 5000
LEAST_ODDS = math.log(5)
SURE = 1.96  # standard errors
SCOPE = 3
LENGTHS = range(3, 8)
CACHE = 100_000

# Words in English, German, French and Spanish.
THREATS = (
    "kill", "hurt", "destroy", "beat", "attack", "töten", "umbringen", "verletzen", "tuer", "frapper", "détruire", "matar", "golpear", "destruir",
    "you will die", "you should die", "you must die", "go die", "drop dead", "i will find you", "watch your back", "du wirst sterben",
    "du sollst sterben", "ich finde dich", "tu vas mourir", "tu dois mourir", "je te trouverai", "vas a morir", "debes morir", "te voy a encontrar",
)
TARGET = frozenset("you your yours yourself du dich dir dein deine ihr euch tu toi ton ta tes vous votre vos tú ti tus usted ustedes".split())
NEGATION = frozenset("not no never neither nor nicht kein keine nie niemals ne pas jamais non nunca jamás tampoco".split())
REPORT = frozenset("said says say wrote quoted claims claimed called sagte sagt schrieb zitierte dit disait écrit affirme dijo dice escribió afirma".split())

WORD = re.compile(r"\w+")
CLAUSE = re.compile(r"[.!?;\n]+")
SYMBOLS = ("other", "negation", "report", "target", "insult", "threat")
SCOPES = ("plain", "negated", "reported")
LABELS = tuple((kind, scope, aimed) for kind in ("insult", "threat") for scope in SCOPES for aimed in (False, True))
FEATURES = 3 + len(LABELS)
SEEN = 5  # documents of the sample that a phrase must occur in for its weight to be learned


def beginnings(word: str) -> list[str]:
    """Patterns that the word matches: its beginnings, and itself with an end mark."""
    return [word[:k] for k in LENGTHS if k <= len(word)] + [word + "$"]


Steps = dict[tuple, tuple]  # state and symbol to next state and symbol handed on


def negation() -> tuple[object, Steps]:
    steps: Steps = {}
    for left in range(SCOPE + 1):
        for symbol in SYMBOLS:
            marked = f"{symbol}:negated" if left and symbol in ("insult", "threat") else symbol
            steps[left, symbol] = (SCOPE if symbol == "negation" else max(0, left - 1)), marked
    return 0, steps


def reported_speech() -> tuple[object, Steps]:
    steps: Steps = {}
    for said in (False, True):
        for symbol in (*SYMBOLS, "insult:negated", "threat:negated"):
            kind = symbol.partition(":")[0]
            marked = f"{kind}:reported" if said and kind in ("insult", "threat") else symbol
            steps[said, symbol] = (said or symbol == "report"), marked
    return False, steps


def target() -> tuple[object, Steps]:
    ends = [f"{kind}:{scope}" for kind in ("insult", "threat") for scope in SCOPES[1:]]
    return False, {(met, symbol): (met or symbol == "target", symbol) for met in (False, True) for symbol in (*SYMBOLS, *ends)}


def composed(first: tuple[object, Steps], second: tuple[object, Steps]) -> tuple[object, Steps]:
    """One table whose states are pairs: the first one's output is the second one's input."""
    start, steps = (first[0], second[0]), {}
    todo, inputs = [start], {symbol for _, symbol in first[1]}
    reached = {start}
    while todo:
        a, b = todo.pop()
        for symbol in inputs:
            if (a, symbol) not in first[1]:
                continue
            next_a, between = first[1][a, symbol]
            next_b, out = second[1][b, between]
            steps[(a, b), symbol] = (next_a, next_b), out
            if (next_a, next_b) not in reached:
                reached.add((next_a, next_b))
                todo.append((next_a, next_b))
    return start, steps


START, STEPS = composed(composed(negation(), reported_speech()), target())
WORD_SYMBOL = dict.fromkeys(TARGET, "target") | dict.fromkeys(REPORT, "report") | dict.fromkeys(NEGATION, "negation")
PHRASES = {phrase: tuple(phrase.split()) for phrase in THREATS}


def _scope(symbol: str) -> str:
    return symbol.partition(":")[2] or "plain"


@dataclass
class Grammar:
    """``insults`` and ``threats``: weight by pattern and by phrase; ``weights``: of the features and a constant, none before the fit."""

    insults: dict[str, float]
    weights: list[float] = field(default_factory=list)
    threats: dict[str, float] = field(default_factory=lambda: dict.fromkeys(THREATS, 1.0))
    cache: dict[str, float] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        self.trie: dict = {}
        for phrase, weight in self.threats.items():
            node = self.trie
            for word in phrase.split():
                node = node.setdefault(word, {})
            node[""] = weight
        self.single = frozenset(p for p in self.threats if " " not in p)
        self.several = [frozenset(p.split()) for p in self.threats if " " in p]

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": {}}

    def insult(self, word: str) -> float:
        """Weight of the best accepted pattern, 0 if none."""
        weight = self.cache.get(word)
        if weight is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            weight = max((self.insults.get(p, 0.0) for p in beginnings(word)), default=0.0)
            self.cache[word] = weight
        return weight

    def walk(self, words: list[str]) -> dict[tuple[str, str, bool], float]:
        """Weight that leaves the composed machine over one clause, by label."""
        state, left, open_ = START, [], []
        for word in words:
            weight = self.insult(word)
            symbol = WORD_SYMBOL.get(word) or ("insult" if weight else "other")
            nodes = [n[word] for n in (*open_, self.trie) if word in n]
            open_ = nodes
            for node in nodes:
                if "" in node:
                    left.append(("threat", _scope(STEPS[state, "threat"][1]), node[""]))
            if weight:
                left.append(("insult", _scope(STEPS[state, "insult"][1]), weight))
            state = STEPS[state, symbol][0]
        out: dict[tuple[str, str, bool], float] = {}
        for kind, scope, weight in left:
            label = kind, scope, state[1]
            out[label] = out.get(label, 0.0) + weight
        return out

    def clause(self, words: list[str]) -> tuple[float, float, float, float, float]:
        """Plain, targeted, negated, reported insult weight and targeted threat weight of one clause."""
        out = self.walk(words)

        def weigh(kind: str, scope: str, aimed: tuple = (False, True)) -> float:
            return sum(out.get((kind, scope, a), 0.0) for a in aimed)

        return (
            weigh("insult", "plain"), weigh("insult", "plain", (True,)), weigh("insult", "negated"), weigh("insult", "reported"),
            weigh("threat", "plain", (True,)),
        )

    def features(self, text: str) -> list[float]:
        low = text.lower()
        found = set(WORD.findall(low))
        threats = not found.isdisjoint(self.single) or any(p <= found for p in self.several)
        if not threats and not any(self.insult(w) for w in found):
            return [0.0] * FEATURES
        totals = dict.fromkeys(LABELS, 0.0)
        strongest, matched, parts = 0.0, 0, CLAUSE.split(low)
        for part in parts:
            out = self.walk(WORD.findall(part))
            plain = sum(weight for (_, scope, _), weight in out.items() if scope == "plain")
            strongest, matched = max(strongest, plain), matched + (plain > 0)
            for label, weight in out.items():
                totals[label] += weight
        return [strongest, *map(math.log1p, (matched, 100 * matched / len(parts), *totals.values()))]

    def score(self, text: str | None) -> float:
        if not self.weights:
            return 0.0
        z = self.weights[-1] + sum(w * x for w, x in zip(self.weights, self.features(text or ""), strict=False))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def phrases_in(words: list[str]) -> set[str]:
    """Threat words and phrases of the fixed list that occur."""
    found = set(words)
    spaced = f" {' '.join(words)} "
    return {p for p, parts in PHRASES.items() if found.issuperset(parts) and f" {p} " in spaced}


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_label: int) -> DataFrame:
    """``text`` and ``toxic`` of at most ``per_label`` documents of each label."""
    known = labels.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("toxic")).filter("id is not null")
    order = [F.xxhash64("id"), "id"]
    few = [known.filter(F.col("toxic") == k).orderBy(*order).limit(per_label) for k in (0, 1)]
    picked = few[0].unionByName(few[1])
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(picked), "id").select("text", "toxic")  # the bound is 2 * per_label ids


def fitted(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    per_label: int = PER_LABEL,
) -> Grammar:
    """The grammar of these labelled rows; ``labels`` hold no row that is held out."""
    sample = _sample(docs, labels, id_col, text_col, label_col, per_label)

    def patterns(columns: list[list]) -> list[list]:
        counts = [Counter(), Counter()]
        for text, toxic in zip(*columns, strict=True):
            counts[toxic][""] += 1
            words = WORD.findall(text.lower())
            counts[toxic].update({p for w in set(words) for p in beginnings(w)} | {f"threat {p}" for p in phrases_in(words)})
        every = list(counts[0].keys() | counts[1].keys())
        return [every, [counts[0][p] for p in every], [counts[1][p] for p in every]]

    counted = map_slices(sample, patterns, schema_of(pattern="string", clean="long", toxic="long"))
    counted = counted.groupBy("pattern").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sizes = counted.filter("pattern = ''").collect()
    if not sizes or not sizes[0].clean or not sizes[0].toxic:
        return Grammar({})
    clean, toxic = sizes[0].clean, sizes[0].toxic
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    is_phrase = F.col("pattern").startswith("threat ")
    strong = counted.filter("pattern <> ''").withColumn("odds", odds).filter((F.col("odds") - SURE * error >= LEAST_ODDS) | is_phrase)
    rows = strong.orderBy("pattern").collect()
    threats = {r.pattern[7:]: max(0.0, r.odds) for r in rows if r.pattern.startswith("threat ") and r.clean + r.toxic >= SEEN}
    insults = _pruned({r.pattern: (r.odds, r.toxic) for r in rows if not r.pattern.startswith("threat ")})
    grammar = Grammar(insults, threats=dict.fromkeys(THREATS, 1.0) | threats)

    def features(columns: list[list]) -> list[list]:
        return [[grammar.features(t) for t in columns[0]], columns[1]]

    seen = map_slices(sample, features, schema_of(x="array<double>", toxic="int")).collect()
    order = sorted((tuple(r.x), r.toxic) for r in seen)
    shares = labels.groupBy(F.col(label_col).alias("k")).count().collect()
    y = np.array([r[1] for r in order], float)
    grammar.weights = regression(np.array([r[0] for r in order]), y, {r.k: r["count"] for r in shares})
    return grammar


def _pruned(found: dict[str, tuple[float, int]]) -> dict[str, float]:
    """Drop a beginning where a longer one covers nine tenths of its documents at higher odds."""
    better = set()
    for p, (odds, n) in found.items():
        for k in LENGTHS:
            q = p.rstrip("$")[:k]
            if q != p and q in found and odds > found[q][0] and n >= 0.9 * found[q][1]:
                better.add(q)
    return {p: odds for p, (odds, _) in found.items() if p not in better}


def regression(
    x: np.ndarray, y: np.ndarray, counts: dict[int, int], penalty: float = 0.1, steps: int = 50
) -> list[float]:
    """Weights and constant of a ridge-penalised logistic regression, classes weighted by their counts outside the sample."""
    x = np.hstack([x, np.ones((len(x), 1))])
    total = counts[0] + counts[1]
    share = np.where(y > 0, counts[1] / y.sum(), counts[0] / (1 - y).sum()) * (len(y) / total)
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        grad = x.T @ (share * (p - y)) + ridge * w
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return [float(v) for v in w]


def scored(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id``, ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def rows(columns: list[list]) -> list[list]:
        scores = [shared.value.score(t) for t in columns[1]]
        return [columns[0], scores, [int(s >= 0.5) for s in scores]]

    schema = schema_of(id=docs.schema[id_col].dataType, score="double", predicted="int")
    return map_slices(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), rows, schema)


def without_toxic(docs: DataFrame, grammar: Grammar, text_col: str = "text") -> DataFrame:
    """The documents, all columns, that are not predicted toxic."""
    shared, at = docs.sparkSession.sparkContext.broadcast(grammar), docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_of(batch, SLICE):
                yield part.filter(pa.array([shared.value.score(t) < 0.5 for t in part.column(at).to_pylist()], pa.bool_()))
        shared.value.cache.clear()
        released()

    return in_small_batches(docs).mapInArrow(keep, docs.schema)
