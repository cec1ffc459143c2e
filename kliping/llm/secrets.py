"""Secret scans: fixed patterns, and probabilistic automata inferred from the credentials those find.

Patterns (fixed values below) give the labelled credentials: the kind is the
label. A sample of at most ``PER_KIND`` distinct strings per kind, those with
the smallest hashes over the whole table, trains one automaton per kind; the
same number of other long tokens trains the background. Each automaton starts
as a prefix tree over character classes; states whose outgoing and ending
frequencies agree under the Hoeffding bound (``ALPHA``) are merged, red-blue
order, with their subtrees folded together. A token's format likelihood is the
best credential automaton's log probability against the background's.

All candidates are scored: runs of 12 or more token characters, less the parts that
pattern spans cover, where 12 or more are left. Those whose log ratio reaches the margin become spans of
kind ``format``. The margin is fitted: a fifth of the samples, by hash, is kept from training,
and the margin lies ``ABOVE`` over all but one in a thousand of its other tokens, but
not below 0. Pattern spans always stay. The span of an assignment is its value.

Ties between kinds do not matter, since the best likelihood alone counts; very long texts and tokens are scored whole.
A null text counts as empty and gives no spans; repeated rows give equal rows;
extra columns are ignored; an empty table gives no rows, a table without
credentials adds no spans. Whole texts are scanned. Positions are code points.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kliping.llm.shared import map_slices, schema_of

# Fixed values.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ["assign", "access", "hex", "format"]

PER_KIND = 1000
SALTS = 64
ALPHA = 0.05
MARGIN = 12.0  # of a grammar without tokens to fit one to
ABOVE = 1.0
CHECKED = 5  # one token of so many is kept from training
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
LEAST = 12
LONG = 256  # longer tokens are scored one by one

# Character classes: symbol and how many characters share it.
CLASSES = {"d": "0123456789", "x": "abcdef", "l": "ghijklmnopqrstuvwxyz", "u": "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | {
    c: c for c in "+/_.=-"
}
SYMBOL = str.maketrans({c: name for name, group in CLASSES.items() for c in group})
NUMBERS = np.zeros(256, np.int64)
for _number, _group in enumerate(CLASSES.values()):
    NUMBERS[list(_group.encode())] = _number
SHARE = {name: -math.log(len(group)) for name, group in CLASSES.items()}

Span = tuple[int, int, int]  # start, kind, end


def pattern_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and kind."""
    found = [(m.start(2), 0, m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """Token runs, less what spans cover."""
    out, at, reach = [], 0, 0
    for m in TOKEN.finditer(text):
        a, b = m.span()
        a = max(a, reach)
        while at < len(spans) and spans[at][0] < b:
            low, _, high = spans[at]
            if low - a >= LEAST:
                out.append((a, low))
            a = reach = max(a, reach, high)
            at += 1
        if b - a >= LEAST:
            out.append((a, b))
    return out


@dataclass
class Automaton:
    """``steps[state][symbol]`` is (next state, log probability); ``end[state]`` the log probability of ending there."""

    steps: list[dict[str, tuple[int, float]]]
    end: list[float]

    def log_likelihood(self, symbols: str) -> float:
        """Of the token with these class symbols, evenly shared within a class."""
        state, total = 0, 0.0
        for s in symbols:
            step = self.steps[state].get(s) if state >= 0 else None
            if step is None:
                # Left the grammar: every further character costs the least likely step.
                state = -1
                total += self.floor + SHARE[s]
            else:
                state, p = step
                total += p + SHARE[s]
        return total + (self.end[state] if state >= 0 else self.floor)

    floor: float = math.log(1e-4)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Next state and log probability by state and symbol, and that of ending; the last state is that outside the grammar."""
        if not hasattr(self, "_tables"):
            n = len(self.steps)
            to, log = np.full((n + 1, len(CLASSES)), n), np.full((n + 1, len(CLASSES)), self.floor)
            for state, steps in enumerate(self.steps):
                for k, symbol in enumerate(CLASSES):
                    if symbol in steps:
                        to[state, k], log[state, k] = steps[symbol]
            self._tables = to, log + np.array(list(SHARE.values())), np.array([*self.end, self.floor])
        return self._tables

    def log_likelihoods(self, codes: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Of many tokens, whose class numbers lie behind one another."""
        to, log, end = self.tables()
        state, total = np.zeros(len(start), np.int64), np.zeros(len(start))
        live = np.arange(len(start))
        for k in range(int(length.max(initial=0))):
            live = live[length[live] > k]
            symbol = codes[start[live] + k]
            total[live] += log[state[live], symbol]
            state[live] = to[state[live], symbol]
        return total + end[state]


def infer(strings: list[str], alpha: float = ALPHA) -> Automaton:
    """Merge compatible states of the prefix tree of class-symbol strings."""
    kids: list[dict[str, int]] = [{}]
    passed, ended = [0], [0]
    for s in sorted(strings):
        at = 0
        passed[0] += 1
        for c in s:
            if c not in kids[at]:
                kids[at][c] = len(kids)
                kids.append({})
                passed.append(0)
                ended.append(0)
            at = kids[at][c]
            passed[at] += 1
        ended[at] += 1
    bound = math.sqrt(0.5 * math.log(2 / alpha))

    def differ(f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > bound * (n1**-0.5 + n2**-0.5)

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = passed[a], passed[b]
            if not n or not m:
                continue
            if differ(ended[a], n, ended[b], m):
                return False
            for c in kids[a].keys() | kids[b].keys():
                x, y = kids[a].get(c), kids[b].get(c)
                if differ(passed[x] if x is not None else 0, n, passed[y] if y is not None else 0, m):
                    return False
                if x is not None and y is not None:
                    todo.append((x, y))
        return True

    flow: list[dict[str, int]] = []  # how often each transition was taken, kept apart from the visits of its target

    def fold(a: int, b: int) -> None:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            passed[a] += passed[b]
            ended[a] += ended[b]
            for c, y in kids[b].items():
                flow[a][c] = flow[a].get(c, 0) + flow[b][c]
                if c in kids[a]:
                    todo.append((kids[a][c], y))
                else:
                    kids[a][c] = y

    flow = [{c: passed[y] for c, y in k.items()} for k in kids]
    red = [0]
    inside = {0}
    blue = [(a, c) for a in red for c in sorted(kids[a])]
    while blue:
        a, c = blue.pop(0)
        b = kids[a][c]
        if b in inside:
            continue
        for r in red:
            if compatible(r, b):
                kids[a][c] = r
                fold(r, b)
                break
        else:
            red.append(b)
            inside.add(b)
        # The frontier is read anew, since folding adds transitions to red states.
        blue = [(s, x) for s in red for x in sorted(kids[s]) if kids[s][x] not in inside]
    number = {s: i for i, s in enumerate(red)}
    steps, end = [], []
    for s in red:
        total = ended[s] + sum(flow[s].values())
        width = len(CLASSES) + 1  # one for the end; unseen symbols leave the grammar
        steps.append({c: (number[kids[s][c]], math.log((n + 0.5) / (total + 0.5 * width))) for c, n in flow[s].items()})
        end.append(math.log((ended[s] + 0.5) / (total + 0.5 * width)))
    return Automaton(steps, end)


@dataclass
class Grammar:
    """Automata per credential kind, and one of other tokens; without credentials it scores nothing."""

    kinds: list[Automaton]
    other: Automaton
    margin: float = MARGIN

    def score(self, token: str) -> float:
        """Log ratio of the token as a credential against the background."""
        s = token.translate(SYMBOL)
        return max((k.log_likelihood(s) for k in self.kinds), default=-math.inf) - self.other.log_likelihood(s)

    def scores(self, tokens: list[str]) -> np.ndarray:
        """Log ratios of many tokens."""
        length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        out = np.full(len(tokens), -math.inf)
        if not self.kinds or not tokens:
            return out
        short = np.flatnonzero(length <= LONG)
        codes = NUMBERS[np.frombuffer("".join([tokens[k] for k in short.tolist()]).encode(), np.uint8)]
        size = length[short]
        start = np.cumsum(size) - size
        best = np.max([k.log_likelihoods(codes, start, size) for k in self.kinds], axis=0)
        out[short] = best - self.other.log_likelihoods(codes, start, size)
        for k in np.flatnonzero(length > LONG).tolist():
            out[k] = self.score(tokens[k])
        return out


def labelled_sample(docs: DataFrame, text_col: str = "text", per_kind: int = PER_KIND) -> DataFrame:
    """``kind`` and ``token``: the distinct strings with the smallest hashes per kind, ``other`` for the rest.

    Each task hands on at most ``per_kind`` strings of a kind and slice.
    """

    def smallest(columns: list[list]) -> list[list]:
        seen: dict[str, set[str]] = defaultdict(set)
        for text in columns[0]:
            spans = pattern_spans(text)
            for a, kind, b in spans:
                seen[KINDS[kind]].add(text[a:b])
            seen["other"].update(text[a:b] for a, b in candidates(text, spans))
        rows = [(k, h, t) for k, tokens in seen.items() for h, t in heapq.nsmallest(per_kind, map(_hashed, tokens))]
        return [[r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]]

    found = map_slices(
        docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")), smallest,
        schema_of(kind="string", hash="long", token="string"),
    ).groupBy("kind", "hash", "token").agg(F.lit(1).alias("one"))
    # First within each of SALTS parts of a kind, so that the last task of a kind gets a bounded number, however many tasks there are.
    for of in (["kind", "part"], ["kind"]):
        rank = F.row_number().over(Window.partitionBy(*of).orderBy("hash", "token"))
        found = found.withColumn("part", F.pmod("hash", F.lit(SALTS))).withColumn("rank", rank).filter(F.col("rank") <= per_kind)
    return found.select("kind", "token")


def _hashed(token: str) -> tuple[int, str]:
    return int.from_bytes(hashlib.blake2b(token.encode(), digest_size=7).digest(), "big"), token


def fitted(docs: DataFrame, text_col: str = "text", per_kind: int = PER_KIND) -> Grammar:
    """Automata from at most ``per_kind`` strings of each of four kinds, which are all that reaches the driver."""
    return learned(labelled_sample(docs, text_col, per_kind).collect())[0]


def learned(sample: list[tuple[str, str]]) -> tuple[Grammar, dict[str, float]]:
    """The grammar of (kind, token) rows, and the share of the tokens kept from training that it finds, by kind."""
    by: dict[str, list[str]] = defaultdict(list)
    kept: dict[str, list[str]] = defaultdict(list)
    for kind, token in sorted(map(tuple, sample)):
        (kept if _hashed("kept " + token)[0] % CHECKED == 0 else by)[kind].append(token)
    trained = {k: infer([t.translate(SYMBOL) for t in by[k]]) for k in [*KINDS[:3], "other"] if by[k] or k == "other"}
    grammar = Grammar([a for k, a in trained.items() if k != "other"], trained["other"])
    others = np.sort(grammar.scores(kept["other"]))
    if len(others):
        grammar.margin = max(0.0, float(others[max(0, len(others) - 1 - len(others) // 1000)])) + ABOVE
    return grammar, {k: float((grammar.scores(kept[k]) >= grammar.margin).mean()) for k in [*KINDS[:3], "other"] if kept[k]}


def scan(
    docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text", margin: float | None = None
) -> DataFrame:
    """One row per document: id, counts by kind, digest of the pattern spans, all spans as text."""

    least = grammar.margin if margin is None else margin

    def rows(columns: list[list]) -> list[list]:
        out: list[list] = [columns[0], *([] for _ in range(6))]
        found = [pattern_spans(text) for text in columns[1]]
        places = [(i, a, b) for i, (text, base) in enumerate(zip(columns[1], found, strict=True)) for a, b in candidates(text, base)]
        high = np.flatnonzero(grammar.scores([columns[1][i][a:b] for i, a, b in places]) >= least).tolist()
        learned_spans: list[list[Span]] = [[] for _ in found]
        for k in high:
            i, a, b = places[k]
            learned_spans[i].append((a, 3, b))
        for base, more in zip(found, learned_spans, strict=True):
            every = sorted(base + more) if more else base
            for kind in range(3):
                out[1 + kind].append(sum(s[1] == kind for s in base))
            out[4].append(hashlib.sha256(shown(base).encode()).hexdigest())
            out[5].append(shown(every))
            out[6].append(len(more))
        return out

    schema = schema_of(
        id=docs.schema[id_col].dataType, n_assign="long", n_access="long", n_hex="long", base_sha256="string",
        spans="string", n_format="long",
    )
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return map_slices(texts, rows, schema)


def shown(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
