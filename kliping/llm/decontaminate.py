"""Benchmark decontamination over a positional inverted index.

The training texts are indexed in segments of a few hundred documents, each one
row of a stored table: for every test term that occurs, its positions in the
segment, the documents lying behind one another. Terms outside the test set are
never looked up, so they are not stored. Term counts summed over all segments
say how rare each test term is. A test window, ``WINDOW`` consecutive words of
an item or a shorter item as a whole, is then looked up in every segment: the
postings of its rarest term give the possible starts, and the postings of the
others, in order of rarity and shifted by their offsets, thin them out.

Two kinds of match come back: exact phrases, and proximity matches, where every
word of a window stands within ``SLACK`` words of its place, counted from its
rarest word and inside that one's document. Only exact phrases make a document
contaminated.

Segments stay where their documents are, so neither a common word nor a passage
that a third of the documents share moves data or gathers in a task; only term
counts are shuffled. The test set is given to every task in blocks of at most
``BLOCK_WORDS`` words, so a large one costs further passes, not more memory.

Words are lower-cased (A-Z) runs of letters, digits and code points above 127.
A null text has no words; null item ids are shown as an empty text; repeated
items count once, repeated documents each; extra columns are ignored; without
test items no document is hit. Windows never span two documents.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from kliping.llm.shared import map_slices, schema_of, stored, without

WINDOW = 10
SLACK = 3
BLOCK_WORDS = 500_000

_WORD = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
PLAIN = bytes(b if b in _WORD else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(PLAIN).split()


class Block:
    """The distinct windows of some test items, as rows of term numbers."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.terms: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.terms.setdefault(w, len(self.terms)) for w in text]
            for a in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[a : a + window]), set()).add(item)
        self.items = [sorted(x) for x in found.values()]
        self.length = np.array([len(w) for w in found], np.int64)
        self.window = np.full((len(found), window), -1, np.int64)
        for row, w in zip(self.window, found, strict=True):
            row[: len(w)] = w

    def rank(self, counts: dict[int, int]) -> None:
        """Order each window's places by how rare their terms are in the training texts; padding comes last."""
        rarity = np.array([*(counts.get(t, 0) for t in range(len(self.terms))), np.iinfo(np.int64).max])
        self.order = np.argsort(rarity[self.window], axis=1, kind="stable")
        key = np.take_along_axis(self.window, self.order[:, :1], 1)[:, 0] if len(self.window) else np.zeros(0, np.int64)
        self.by_key = np.argsort(key, kind="stable")
        self.keys, self.first = np.unique(key[self.by_key], return_index=True)
        self.last = np.append(self.first[1:], len(key)).astype(np.int64)

    def search(
        self, terms: np.ndarray, counts: np.ndarray, positions: np.ndarray, lengths: np.ndarray, slack: int = SLACK
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Window numbers, documents, starts there and whether exact, of all proximity matches in a segment.

        ``lengths`` are those of its documents, in words. A match is in the document of its rarest term, and a
        start may lie before it. Documents are moved apart, so that no lookup reaches from one into another.
        """
        ends = np.cumsum(counts)
        room = self.window.shape[1] + slack
        begins = np.cumsum(lengths) - lengths + room * np.arange(len(lengths))
        doc_of = np.searchsorted(np.cumsum(lengths), positions, "right")
        positions = positions + room * doc_of
        _, in_segment, in_keys = np.intersect1d(terms, self.keys, assume_unique=True, return_indices=True)
        picked, starts, docs = [], [], []
        for s, k in zip(in_segment, in_keys, strict=True):
            here = slice(ends[s] - counts[s], ends[s])
            at = positions[here]
            own = self.by_key[self.first[k] : self.last[k]]
            picked.append(np.repeat(own, len(at)))
            starts.append(np.tile(at, len(own)) - np.repeat(self.order[own, 0], len(at)))
            docs.append(np.tile(doc_of[here], len(own)))
        if not picked:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        # The postings by position, with room for shifts beyond either end of each document.
        at_place = np.full(int(lengths.sum()) + (len(lengths) + 1) * room, -2, np.int64)
        at_place[positions + room] = np.repeat(terms, counts)
        w, start, doc = np.concatenate(picked), np.concatenate(starts), np.concatenate(docs)
        exact = np.ones(len(w), bool)
        for k in range(1, self.window.shape[1]):
            place = self.order[w, k]
            term = self.window[w, place]
            spot = start + place + room
            same = (at_place[spot] == term) | (term < 0)
            near = same.copy()
            for shift in (*range(-slack, 0), *range(1, slack + 1)):
                near |= at_place[spot + shift] == term
            exact &= same
            w, start, doc, exact = w[near], start[near], doc[near], exact[near]
        start = start - begins[doc]
        # A window is inside the text, but for the slack of a proximity match.
        exact &= (start >= 0) & (start + self.length[w] <= lengths[doc])
        return w, doc, start, exact


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> list[list[tuple[str, list[bytes]]]]:
    """The items in blocks; each passes the driver once."""
    blocks, size = [[]], 0
    for item, text in benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")), text_col).toLocalIterator():
        own = words(text)
        if size and size + len(own) > block_words:
            blocks.append([])
            size = 0
        blocks[-1].append((item, own))
        size += len(own)
    return blocks


def index(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """Segments of ``row``, ``id``, ``digest``, ``text`` documents: their keys and lengths, and the postings of ``terms``."""
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def segment(columns: list[list]) -> list[list]:
        rows, ids, digests, texts = columns
        split = [words(t) for t in texts]
        lengths = [len(x) for x in split]
        number = np.fromiter(
            (n for x in split for n in map(known.value.get, x, repeat(-1))), np.int64, sum(lengths)
        )
        place = np.flatnonzero(number >= 0)
        by_term = place[np.argsort(number[place], kind="stable")]
        found, counts = np.unique(number[place], return_counts=True)
        return [[rows], [ids], [digests], [lengths], [found.astype("i4")], [counts.astype("i4")], [by_term.astype("i4")]]

    schema = schema_of(
        row="array<long>", id=ArrayType(docs.schema["id"].dataType), digest="array<long>", n_words="array<int>",
        terms="array<int>", counts="array<int>", positions="array<int>",
    )
    return stored(map_slices(docs.select("row", "id", "digest", "text"), segment, schema), "postings")


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _matches(segments: DataFrame, block: Block) -> DataFrame:
    """One row per document of the segments: ``spans`` of exact matches, ``items`` and ``near`` items."""
    shared = segments.sparkSession.sparkContext.broadcast(block)

    def find(columns: list[list]) -> list[list]:
        out: list[list] = [[] for _ in range(7)]
        for rows, ids, digests, lengths, terms, counts, positions in zip(*columns, strict=True):
            block, n = shared.value, len(rows)
            w, doc, start, exact = block.search(*(np.array(x, np.int64) for x in (terms, counts, positions, lengths)))
            spans: list[list] = [[] for _ in range(n)]
            items: list[set] = [set() for _ in range(n)]
            near: list[set] = [set() for _ in range(n)]
            for d, x, a, e in zip(doc.tolist(), w.tolist(), start.tolist(), exact.tolist(), strict=True):
                near[d].update(block.items[x])
                if e:
                    spans[d].append((a, a + int(block.length[x])))
                    items[d].update(block.items[x])
            for place, value in zip(
                out, (rows, ids, digests, lengths, [[list(x) for x in _merged(s)] for s in spans], map(sorted, items), map(sorted, near)),
                strict=True,
            ):
                place.extend(value)
        return out

    schema = schema_of(
        row="long", id=segments.schema["id"].dataType.elementType, digest="long", n_words="int",
        spans="array<array<int>>", items="array<string>", near="array<string>",
    )
    return map_slices(segments, find, schema)


def search(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document.

    ``id``, ``digest`` of the text, ``n_words``, ``n_hit`` (words inside exact matches), ``n_items``,
    ``items_sha256`` of the sorted item ids, ``contaminated``, ``spans`` (word ranges), ``items`` and ``near`` items.
    """
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text"),
    )
    blocks = _blocks(benchmark, item_col, item_text_col, block_words)
    if len(blocks) > 1:
        texts = stored(texts, "numbered-texts")  # so that a row keeps its number from pass to pass
    parts = []
    for items in blocks:
        block = Block(items, window)
        segments = index(texts, block.terms)
        counts = segments.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(
            F.sum("x.counts")
        )
        block.rank(dict(map(tuple, counts.collect())))  # one row per test term of the block
        parts.append(_matches(segments, block))
    rows = parts[0]
    if len(parts) > 1:
        lists = [F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("spans", "items", "near")]
        rows = reduce(DataFrame.unionByName, parts).groupBy("row").agg(
            *(F.first(c).alias(c) for c in ("id", "digest", "n_words")), *lists
        )

    def finish(columns: list[list]) -> list[list]:
        ids, digests, lengths, spans, items, near = columns
        spans = [_merged(s) for s in spans]
        items = [sorted(set(x)) for x in items]
        return [
            ids, digests, lengths, [sum(b - a for a, b in s) for s in spans], [len(x) for x in items],
            [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], [bool(s) for s in spans],
            [[list(x) for x in s] for s in spans], items, [sorted(set(x)) for x in near],
        ]

    schema = schema_of(
        id=docs.schema[id_col].dataType, digest="long", n_words="long", n_hit="long", n_items="long",
        items_sha256="string", contaminated="boolean", spans="array<array<int>>", items="array<string>",
        near="array<string>",
    )
    return map_slices(rows.select("id", "digest", "n_words", "spans", "items", "near"), finish, schema)


def clean(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW,
) -> DataFrame:
    """The documents, same columns, that hold no test window."""
    found = search(docs, benchmark, id_col, text_col, item_col, item_text_col, window)
    return without(docs, found.filter("contaminated"), id_col, text_col)
