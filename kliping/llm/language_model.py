"""A word model of hierarchical Pitman-Yor restaurants, and the log probability of every text under it.

Each word that something followed is a context restaurant whose customers are the
words behind it; all share one parent, the root restaurant, whose base is uniform over
the known words and one unknown. A customer sits at a table that serves its word or
opens one, and every table of a context is a customer of the root. A sweep of
Gibbs sampling takes all customers of a word in a context out and seats them again, one
after the other, given the tables of all others as the sweep before left them (so that
restaurants can be swept side by side), then does the same in the root. After ``BURN``
sweeps the predictive probabilities of ``SAMPLES`` states are averaged. Discounts come
from the counts of words and pairs seen once and twice; the strengths are parameters.

A pair seen once has one table in every state, so sweeps carry the others alone. These
are drawn customer by customer up to ``STEPS``, beyond that by thinning: customers who
might open a table are drawn at a rate that is too high for a stretch, and each is
then accepted by its exact probability.

Distribution. Documents are cut into slices of about ``SLICE_TOKENS`` tokens, whose
distinct words and distinct pairs alone are exchanged, packed into one row per slice and
receiver. Words are dealt to ``VOCABULARY_WORDS`` of them a task and get numbers and exact
counts there. Pairs are dealt to blocks of about ``BLOCK_TOKENS`` tokens by their
context, those of a context with more than an eighth of that by both words, so neither
a hot context nor a hot pair gathers in a task: a pair comes once a slice. A block's
words ask the tasks that hold the root's tables for their state, and hand in the tables of a sweep.
Every draw depends on the seed, the words and the sweep, so a task that is run again
draws the same, and states need not be kept: the last step draws them again.

A text's tokens are its words (runs without white space, A-Z lower-cased) and one end.
Null and empty texts are an end alone. Repeated rows are documents of their own and are
learned from each; null ids are allowed; extra columns are ignored. One text is never
cut, so a very long one makes a slice of its own. Without training documents every
probability is that of the base. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructType

from kliping.llm.packed import pack, rows_of, table_of, unpack
from kliping.llm.shared import dropped, schema_of, stored

SLICE_TOKENS = 1_000_000
VOCABULARY_WORDS = 2_000_000  # entries of all slices' word lists that one task numbers
BLOCK_TOKENS = 2_000_000
STRENGTH = 1.0
ROOT_STRENGTH = 1.0
BURN = 1
SAMPLES = 3
SEED = 1
STEPS = 1024

UNIT = 1 << 16  # steps of a log probability on its way back to the texts

END = b""
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_U = np.uint64


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LOWER).split()


# -- seating ---------------------------------------------------------------------


def uniform(key: np.ndarray, sweep: int, step: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on the arguments alone."""
    with np.errstate(over="ignore"):
        x = key.astype(np.int64).view(_U) + _U(sweep * 0x9E3779B97F4A7C15 + step * 0xD1B54A32D192ED03 & (1 << 64) - 1)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        x ^= x >> _U(31)
    return ((x >> _U(11)).astype(np.float64) + 0.5) / (1 << 53)


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (a.astype(np.int64).view(_U) + _U(SEED)) * _U(0x9E3779B97F4A7C15)
        return ((x ^ (x >> _U(32))) + b.astype(np.int64).view(_U) * _U(0xC2B2AE3D27D4EB4F)).view(np.int64)


def seat(customers: np.ndarray, opening: np.ndarray, discount: float, key: np.ndarray, sweep: int) -> np.ndarray:
    """Tables after seating ``customers`` one by one, a new table's weight being ``opening``."""
    tables = np.minimum(customers, 1)
    live = np.flatnonzero(customers > 1)
    for k in range(1, STEPS):
        if not len(live):
            return tables
        t, a = tables[live], opening[live]
        tables[live] += uniform(key[live], sweep, k) * (a + k - discount * t) < a
        live = live[customers[live] > k + 1]
    for x in live.tolist():
        draw = np.random.default_rng([int(key[x]) & (1 << 64) - 1, sweep + 1000])
        tables[x] = _thinned(int(customers[x]), float(opening[x]), discount, int(tables[x]), draw)
    return tables


def _thinned(customers: int, a: float, discount: float, tables: int, draw: np.random.Generator) -> int:
    """Goes on at customer ``STEPS``, in stretches over which the probability of a new table changes by a bounded factor."""
    k = STEPS
    while k < customers:
        stretch = min(customers - k, max(1, int((k - discount * tables) / 2)))
        bound = a / (a + k - discount * (tables + stretch))  # no customer of the stretch is likelier to open one
        at = -1
        while at < stretch:
            mean = stretch * bound
            steps = draw.geometric(min(bound, 1.0), int(mean + 4 * math.sqrt(mean)) + 4)
            places = at + np.cumsum(steps)
            at = int(places[-1])
            places = places[places < stretch]
            for place, u in zip(places.tolist(), draw.random(len(places)).tolist(), strict=True):
                tables += u * bound * (a + k + place - discount * tables) < a
        k += stretch
    return tables


def discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once + twice else 0.5


# -- slices and words ------------------------------------------------------------


def _slices(docs: DataFrame, slice_tokens: int) -> DataFrame:
    """Of ``id``, ``text``, ``held``: a slice's words and pairs, how often training texts have each, and the pairs of every document.

    A pair is known by the places of its words in the slice's own list. A document's pairs are sorted; their order does
    not matter any more.
    """
    schema = schema_of(
        slice="long", ids=ArrayType(docs.schema["id"].dataType), held="array<boolean>", lengths="array<int>", pairs="binary",
        a="binary", b="binary", n="binary", words="binary", counts="binary", n_words="int", n_tokens="long",
    )
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        known, ids, held, parts, size = {END: 0}, [], [], [], 0

        def send() -> pa.RecordBatch:
            lengths = [len(p) for p in parts]
            tokens = np.concatenate(parts)
            learned = np.repeat(~np.array(held, bool), lengths)
            counts = np.bincount(tokens[learned], minlength=len(known))
            first = np.cumsum(lengths) - lengths
            before = np.concatenate([[0], tokens[:-1]]).astype(np.int64)
            before[first] = 0  # a text begins behind an end
            pairs, of = np.unique(before * len(known) + tokens, return_inverse=True)
            n = np.bincount(of[learned], minlength=len(pairs))
            a, b = pairs // len(known), pairs % len(known)
            row = (
                number, ids, held, lengths, _by_document(lengths, of, len(pairs)), pack(np.diff(a, prepend=0)), pack(b), pack(n),
                pack(np.frombuffer(b"\n".join(known), np.uint8)), pack(counts), len(known), len(tokens),
            )
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, out, strict=True)], schema=out)

        for batch in batches:
            for key, text, out_of in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                own = [known.setdefault(w, len(known)) for w in words(text.as_py())]
                own.append(0)
                parts.append(np.array(own, np.int32))
                ids.append(key)
                held.append(out_of)
                size += len(own)
                if size >= slice_tokens:
                    yield send()
                    known, ids, held, parts, size, number = {END: 0}, [], [], [], 0, number + 1
        if size:
            yield send()

    return stored(docs.select("id", "text", "held").mapInArrow(run, schema), "token-slices")


def _by_document(lengths: list[int], pairs: np.ndarray, size: int) -> bytes:
    return pack(np.diff(np.sort(np.repeat(np.arange(len(lengths)), lengths) * size + pairs), prepend=0))


ASKED = dict(q="int", slice="long", at="binary", words="binary", counts="binary")
NUMBERED = dict(slice="long", at="binary", numbers="binary", counts="binary", known="long", total="long", once="long", twice="long")


def _word_numbers(slices: DataFrame, tasks: int) -> DataFrame:
    """Numbers and training counts of each slice's words; sums over the words of a task stand in one of its rows."""
    asked, numbered = schema_of(**ASKED), schema_of(**NUMBERED)
    out = to_arrow_schema(asked)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(pa.Table.from_batches([batch])):
                own = unpack(row["words"], np.uint8).tobytes().split(b"\n")
                counts = unpack(row["counts"])
                of = np.fromiter((xxhash.xxh3_64_intdigest(w) % tasks for w in own), np.int64, len(own))
                for q in np.unique(of).tolist():
                    at = np.flatnonzero(of == q)
                    blob = np.frombuffer(b"\n".join([own[k] for k in at]), np.uint8)
                    one = (q, row["slice"], pack(np.diff(at, prepend=0)), pack(blob), pack(counts[at]))
                    yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(one, out, strict=True)], schema=out)

    def number(key: tuple, table: pa.Table) -> pa.Table:
        known: dict[bytes, int] = {}
        lists, sums = [], np.zeros(0, np.int64)
        for row in rows_of(table):
            own = np.array([known.setdefault(w, len(known)) for w in unpack(row["words"], np.uint8).tobytes().split(b"\n")], np.int64)
            sums = np.concatenate([sums, np.zeros(len(known) - len(sums), np.int64)])
            sums[own] += unpack(row["counts"])  # words of a slice are distinct
            lists.append((row["slice"], row["at"], own))
        # Frequent words get small numbers; ties go by the word, not by the order of arrival.
        by_word = np.array([known[w] for w in sorted(known)], np.int64)
        rank = np.empty(len(known), np.int64)
        rank[by_word[np.argsort(-sums[by_word], kind="stable")]] = np.arange(len(known))
        totals = [int((sums > 0).sum()), int(sums.sum()), int((sums == 1).sum()), int((sums == 2).sum())]
        nothing = [0] * 4
        return table_of([
            (s, at, pack(rank[own] * tasks + key[0].as_py()), pack(sums[own]), *(nothing if k else totals)) for k, (s, at, own) in enumerate(lists)
        ], numbered)

    asks = slices.select("slice", "words", "counts").mapInArrow(ask, asked)
    return stored(asks.groupBy("q").applyInArrow(number, numbered), "word-numbers")


# -- pairs -----------------------------------------------------------------------

PAIRS = dict(block="int", slice="long", start="int", size="int", a="binary", b="binary", n="binary")


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x.astype(np.int64).view(_U) * _U(0x9E3779B97F4A7C15)
        return (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9) >> _U(33)


def _paired(slices: DataFrame, numbers: DataFrame, known: int, total: int, blocks: int, hot: int) -> DataFrame:
    """Two kinds of rows: a slice's documents with base scores and the pair of each token, and its pairs of each block."""
    schema = StructType([
        *schema_of(ids=slices.schema["ids"].dataType, held="array<boolean>", n_tokens="array<long>", n_known="array<long>",
                   base="array<double>", pairs="binary", n_pairs="int").fields, *schema_of(**PAIRS).fields,
    ])

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in rows_of(left):
            number, count = np.zeros(row["n_words"], np.int64), np.zeros(row["n_words"], np.int64)
            for answer in rows_of(right):
                at = np.cumsum(unpack(answer["at"]))
                number[at], count[at] = unpack(answer["numbers"]), unpack(answer["counts"])
            lengths = np.array(row["lengths"], np.int64)
            first = np.cumsum(lengths) - lengths
            a, b, n = np.cumsum(unpack(row["a"])), unpack(row["b"]), unpack(row["n"])
            of = np.cumsum(unpack(row["pairs"])) % len(a)
            block = _mixed(number[a] + np.where(count[a] > hot, _mixed(number[b]).astype(np.int64), 0)).astype(np.int64) % blocks
            order = np.lexsort((number[b], number[a], block))
            rank = np.empty(len(a), np.int64)
            rank[order] = np.arange(len(a))
            base = np.log10((count + 0.5) / (total + 0.5 * (known + 1)))
            out.append((
                row["ids"], row["held"], lengths, np.add.reduceat(count[b[of]] > 0, first, dtype=np.int64), np.add.reduceat(base[b[of]], first),
                _by_document(row["lengths"], rank[of], len(a)), len(a), None, row["slice"], None, None, None, None, None,
            ))
            edges = np.flatnonzero(np.diff(block[order], prepend=-1)).tolist() + [len(a)]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                at = order[low:high]
                out.append((*[None] * 7, int(block[at[0]]), row["slice"], low, high - low, pack(np.diff(number[a[at]], prepend=0)), pack(number[b[at]]), pack(n[at])))
        return table_of(out, schema)

    both = slices.drop("words", "counts", "n_tokens").groupBy("slice").cogroup(numbers.select("slice", "at", "numbers", "counts").groupBy("slice"))
    return stored(both.applyInArrow(pair, schema), "token-pairs")


class Block:
    """The distinct pairs of some slices, how often training texts have each, and their words in the order of the tasks that hold them."""

    def __init__(self, a: np.ndarray, b: np.ndarray, n: np.ndarray, tasks: int) -> None:
        order = np.lexsort((b, a))
        new = np.ones(len(a), bool)
        new[1:] = (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)
        self.of = np.empty(len(a), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.a, self.b = a[order][new], b[order][new]
        self.n = np.bincount(self.of, n, minlength=len(self.a)).astype(np.int64)
        found = np.unique(np.concatenate([self.a, self.b]))
        by_task = np.lexsort((found, found % tasks))
        self.words = found[by_task]
        rank = np.empty(len(found), np.int64)
        rank[by_task] = np.arange(len(found))
        self.at_a, self.at_b = rank[np.searchsorted(found, self.a)], rank[np.searchsorted(found, self.b)]
        self.key = pair_key(self.a, self.b)
        self.tasks = tasks
        edges = np.flatnonzero(np.diff(self.words % tasks, prepend=-1))
        ends = np.append(edges[1:], len(found))[: len(edges)]
        self.parts = list(zip((self.words[edges] % tasks).tolist(), edges.tolist(), ends.tolist(), strict=True))

    @staticmethod
    def read(table: pa.Table, tasks: int) -> Block:
        columns = [[], [], []]
        for row in rows_of(table):
            for column, name in zip(columns, "abn", strict=True):
                values = unpack(row[name])
                column.append(np.cumsum(values) if name == "a" else values)
        return Block(*map(np.concatenate, columns), tasks)

    def drawn(self) -> Block:
        """The pairs that have more than one customer."""
        many = self.n > 1
        return Block(self.a[many], self.b[many], self.n[many], self.tasks)

    def tallies(self, block: int, live: bool, tables: np.ndarray, customers: np.ndarray) -> list[tuple]:
        """A row for each task that holds words of the block: tables of each as context and as dish, customers as context."""
        sums = [np.bincount(at, x, minlength=len(self.words)).astype(np.int64) for at, x in ((self.at_a, tables), (self.at_b, tables), (self.at_a, customers))]
        return [(q, block, live, pack(np.diff(self.words[x:y], prepend=0)), *(pack(s[x:y]) for s in sums)) for q, x, y in self.parts]


TALLIES = dict(q="int", block="int", live="boolean", words="binary", tables="binary", dishes="binary", customers="binary")
STATES = dict(block="int", live="boolean", q="int", tables="binary", customers="binary", dishes="binary", seated="binary", root_tables="long", root_customers="long")


def _root(tallies: DataFrame, sweep: int, opening: float, root_discount: float) -> DataFrame:
    """The state of each block's words once the root's customers are seated."""
    schema = schema_of(**STATES)

    def seated(key: tuple, table: pa.Table) -> pa.Table:
        rows = [(r["block"], r["live"], np.cumsum(unpack(r["words"])), *(unpack(r[c]) for c in ("tables", "dishes", "customers"))) for r in rows_of(table)]
        found, of = np.unique(np.concatenate([r[2] for r in rows]), return_inverse=True)
        tables, dishes, customers = (np.bincount(of, np.concatenate([r[k] for r in rows]), minlength=len(found)).astype(np.int64) for k in (3, 4, 5))
        own = seat(dishes, np.full(len(found), opening), root_discount, pair_key(found, found), -1 - sweep)
        sums, out, at = (int(own.sum()), int(dishes.sum())), [], 0
        for block, live, numbers, *_ in rows:
            here = of[at : at + len(numbers)]
            at += len(numbers)
            out.append((block, live, key[0].as_py(), pack(tables[here]), None if sweep else pack(customers[here]), pack(dishes[here]), pack(own[here]), *(sums if not out else (0, 0))))
        return table_of(out, schema)

    return stored(tallies.groupBy("q").applyInArrow(seated, schema), "restaurants")


class Weights:
    """Parameters of both levels, and a state's probabilities."""

    def __init__(self, strength: float, discount_: float, root_strength: float, root_discount: float, known: int) -> None:
        self.strength, self.discount, self.root_strength, self.root_discount, self.known = strength, discount_, root_strength, root_discount, known

    def opening(self, root_tables: int) -> float:
        return (self.root_strength + self.root_discount * root_tables) / (self.known + 1)

    def state(self, rows: list[dict], sums: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tables as context, customers as context (in the first state only, as they stay the same) and root probability of a block's words."""
        rows = sorted(rows, key=lambda r: r["q"])
        tables, dishes, seated = (np.concatenate([unpack(r[c]) for r in rows]) for c in ("tables", "dishes", "seated"))
        customers = np.concatenate([unpack(r["customers"] or pack(np.zeros(0, np.int64))) for r in rows])
        return tables, customers, (dishes - self.root_discount * seated + self.opening(sums[0])) / (self.root_strength + sums[1])

    def seated(self, block: Block, state: tuple[np.ndarray, np.ndarray, np.ndarray], sweep: int) -> np.ndarray:
        tables, _, root = state
        new = (self.strength + self.discount * tables[block.at_a]) * root[block.at_b]
        return seat(block.n, new, self.discount, block.key, sweep)

    def predicted(
        self, block: Block, tables: np.ndarray, customers: np.ndarray, state: tuple[np.ndarray, np.ndarray, np.ndarray]
    ) -> np.ndarray:
        all_tables, _, root = state
        shared = (self.strength + self.discount * all_tables[block.at_a]) * root[block.at_b]
        return (block.n - self.discount * tables + shared) / (self.strength + customers[block.at_a])


def scored(
    docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text", strength: float = STRENGTH, root_strength: float = ROOT_STRENGTH,
    burn: int = BURN, samples: int = SAMPLES, slice_tokens: int = SLICE_TOKENS, vocabulary_words: int = VOCABULARY_WORDS, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per document, learned from those where ``held`` is not true.

    ``id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``, the sums over its tokens of the
    log10 probability by smoothed counts and by the model.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(held, F.lit(False)).alias("held"))
    slices = _slices(narrow, slice_tokens)
    n_words, n_tokens = (int(x or 0) for x in slices.agg(F.sum("n_words"), F.sum("n_tokens")).first())
    tasks, blocks = 1 + n_words // vocabulary_words, 1 + n_tokens // block_tokens
    numbers = _word_numbers(slices, tasks)
    known, total, once, twice = (int(x or 0) for x in numbers.agg(*(F.sum(c) for c in ("known", "total", "once", "twice"))).first())
    rows = _paired(slices, numbers, known, total, blocks, block_tokens // 8)
    dropped(slices, numbers)
    pairs = rows.filter("block is not null").select(*PAIRS)

    tally_schema = schema_of(**TALLIES)
    merged_schema = StructType([*schema_of(a="binary", b="binary", n="binary", once="long", twice="long").fields, *tally_schema.fields])

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        """The pairs to be drawn, and the tallies of all others, which stay the same."""
        block, number = Block.read(table, tasks), key[0].as_py()
        once, twice = (int((block.n == k).sum()) for k in (1, 2))
        drawn = block.drawn()
        out = [(*(pack(x) for x in (np.diff(drawn.a, prepend=0), drawn.b, drawn.n)), once, twice, None, number, *[None] * 5)]
        return table_of(out + [(*[None] * 5, *row) for row in block.tallies(number, False, block.n == 1, block.n)], merged_schema)

    merged = stored(pairs.select("block", "a", "b", "n").groupBy("block").applyInArrow(merge, merged_schema), "pair-blocks")
    pair_once, pair_twice = (int(x or 0) for x in merged.agg(F.sum("once"), F.sum("twice")).first())
    weights = Weights(strength, discount(pair_once, pair_twice), root_strength, discount(once, twice), known)
    still = merged.filter("q is not null").select(*TALLIES)

    def opened(key: tuple, table: pa.Table) -> pa.Table:
        block = Block.read(table, tasks)
        return table_of(block.tallies(key[0].as_py(), True, np.ones(len(block.n)), np.zeros(len(block.n))), tally_schema)

    def swept(sweep: int, sums: tuple[int, int]) -> Callable:
        def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            block = Block.read(left, tasks)
            if not len(block.n):
                return table_of([], tally_schema)
            tables = weights.seated(block, weights.state(list(rows_of(right)), sums), sweep)
            return table_of(block.tallies(key[0].as_py(), True, tables, np.zeros(len(block.n))), tally_schema)

        return run

    bare = merged.filter("q is null").select("block", "a", "b", "n").groupBy("block")
    tallies, root_tables, states, sums = bare.applyInArrow(opened, tally_schema), known, [], []
    for sweep in range(burn + samples + 1):
        state = _root(still.unionByName(tallies), sweep, weights.opening(root_tables), weights.root_discount)
        root_tables, root_customers = (int(x or 0) for x in state.agg(F.sum("root_tables"), F.sum("root_customers")).first())
        states.append(state.filter("not live").select(F.lit(sweep).alias("sweep"), "block", "q", "tables", "customers", "dishes", "seated"))
        sums.append((root_tables, root_customers))
        tallies = bare.cogroup(state.filter("live").groupBy("block")).applyInArrow(swept(sweep + 1, sums[-1]), tally_schema)
    dropped(merged)
    history = states[0]
    for state in states[1:]:
        history = history.unionByName(state)

    answer_schema = schema_of(slice="long", start="int", logs="binary")

    def predict(left: pa.Table, right: pa.Table) -> pa.Table:
        places = left.select(["slice", "start", "size"]).to_pylist()
        block = Block.read(left, tasks)
        by_sweep: list[list[dict]] = [[] for _ in sums]
        for row in rows_of(right):
            by_sweep[row["sweep"]].append(row)
        before = weights.state(by_sweep[0], sums[0])
        customers = before[1]
        mean = np.zeros(len(block.a))
        for sweep in range(1, len(sums)):
            tables, before = weights.seated(block, before, sweep), weights.state(by_sweep[sweep], sums[sweep])
            if sweep > burn:
                mean += weights.predicted(block, tables, customers, before) / samples
        logs, out, at = np.rint(np.log10(mean) * UNIT).astype(np.int32)[block.of], [], 0
        for place in places:
            out.append((place["slice"], place["start"], pack(logs[at : at + place["size"]])))
            at += place["size"]
        return table_of(out, answer_schema)

    answers = pairs.groupBy("block").cogroup(history.groupBy("block")).applyInArrow(predict, answer_schema)
    score_schema = schema_of(
        id=docs.schema[id_col].dataType, held_out="boolean", n_tokens="long", n_known="long", train_tokens="long", base_score="double", score="double"
    )

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in rows_of(left):
            logs = np.empty(row["n_pairs"], np.float64)
            for answer in rows_of(right):
                own = unpack(answer["logs"], np.int32)
                logs[answer["start"] : answer["start"] + len(own)] = own / UNIT
            lengths = np.array(row["n_tokens"], np.int64)
            sums = np.add.reduceat(logs[np.cumsum(unpack(row["pairs"])) % len(logs)], np.cumsum(lengths) - lengths)
            out += zip(row["ids"], row["held"], row["n_tokens"], row["n_known"], [total] * len(lengths), row["base"], sums.tolist(), strict=True)
        return table_of(out, score_schema)

    texts = rows.filter("block is null").select("slice", "ids", "held", "n_tokens", "n_known", "base", "pairs", "n_pairs")
    return texts.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(score, score_schema)
