"""Repeated byte strings across all documents, by prefix doubling over sampled suffixes.

Every byte inside a string of ``LENGTH`` bytes that also starts elsewhere, in
the same or another document, is removed. Strings are judged on the input.

Sampling. Each string start picks an anchor: the position of the smallest hash
of eight bytes among the next ``SPAN``. A string decides its anchor alone, so
equal strings have their anchors at the same offset, and consecutive starts
share anchors: about one position in ``SPAN`` / 2 is one. Consecutive anchors cut the
text into chunks, up to its end, behind the last string start too.

Doubling. Positions are ranked by their chunk, then by pairs of ranks at growing
offsets: the rank of the run of 2, 4, 8 ... chunks from a position comes from its
own rank and that of the position 1, 2, 4 ... chunks on. Each round deals the keys by
range, sorts them there and numbers those that occur twice or more; positions with a
unique run leave. All strings of an anchor share the next ``LENGTH - SPAN + 1``
bytes, its threshold: once a run covers the chunks decided by these (a last,
overlapping pair of ranks where their number is no power of two), the anchor is
done. Anchors unique until then hold no repeated string.

Matches. The strings of the anchors left are compared in full, by hashes of 64 bits.
If the text of all strings that share an anchor has an equal elsewhere, they all are
repeated; if the bytes that they have in common have none, they all are unique. The
rest, at the edges of a match, is cut into blocks of fewer strings and compared in
the same way down to single strings, one bearer for each different text. Groups
never turn into pairs.

Passages. ``LENGTH`` bytes are some 60 words of prose, and shorter passages stay. Words
inside runs of ``WORDS`` words that another document holds too are counted beside that, in
``n_passage_words``, whatever their bytes and the blanks between them; nothing is removed for them. Windows
of words have anchors as strings do, and are compared in full where the words that
all windows of an anchor share are in another document.

Distribution. Texts lie in slices of about ``SLICE_BYTES``, a row each. A slice sends
each key once a round, packed in one row per receiver, and gets the ranks back,
so a passage that a third of the documents share costs its receiver a key a slice.

Equal texts are one text from the start. Null texts count as empty; texts below
``LENGTH`` bytes lose nothing; null ids and repeated rows are documents of their
own; a text is never cut, so a very long one makes a slice of its own; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType

from kliping.llm.packed import pack, pack_all, rows_of, table_of, unpack, unpack_all
from kliping.llm.shared import dropped, schema_of, stored

LENGTH = 400
SPAN = 128
GRAM = 8
WORDS = 50  # words of a passage
WORD_SPAN = 24  # windows of words that may share an anchor
WIDTHS = (SPAN, 16, 1)  # strings a block, in the order of comparison
SLICE_BYTES = 4 << 20
KEYS = 2_000_000  # keys of all slices that one task sorts
SEGMENT = 1 << 18

_KEY = np.uint64(0x9E3779B97F4A7C15)
_HIGH = np.uint64(0xFFFFFFFF00000000)
_BASE = 0xD6E8FEB86659FD93
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _KEY
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def _key(*parts: np.ndarray) -> np.ndarray:
    """One key of several numbers."""
    out = np.zeros(len(parts[0]), _U)
    for part in parts:
        out = _mixed(out * _U(31) + part.astype(np.int64).view(_U))
    return out


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of the eight bytes from each position."""
    x = data.astype(_U)
    for k in (1, 2, 4):
        x = (x[:-k] << _U(8 * k)) | x[k:]
    x = (x ^ (x >> _U(29))) * _KEY
    return (x ^ (x >> _U(32))) * _KEY


_BYTES = _mixed(np.arange(1, 257, dtype=_U) * _KEY)


def _bytes(data: np.ndarray) -> np.ndarray:
    """Number of each byte."""
    return _BYTES[data]


def _lowest(x: np.ndarray, span: int) -> np.ndarray:
    """Place of the smallest hash in each run of ``span``; ties go to the first."""
    x = (x & _HIGH) | np.arange(len(x), dtype=_U)
    width = 1
    while width < span:
        step = min(width, span - width)
        x = np.minimum(x[: len(x) - step], x[step:])
        width += step
    return (x & ~_HIGH).astype(np.int64)


def anchors(data: bytes, length: int = LENGTH, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions picked by any run of ``span`` places, and the first and last string start that picks each.

    Those that only runs behind the last string start pick come last and
    without starts; they end the chunks of the others.
    """
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none, none, none
    at = _lowest(_grams(np.frombuffer(data, np.uint8)), span)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.minimum(np.append(first[1:], len(at)) - 1, len(data) - length)
    bearing = int(np.searchsorted(first, len(data) - length, "right"))
    return at[first], first[:bearing], last[:bearing]


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    both = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        x = np.full(size, base, _U)
        x[0] = 1
        both.append(np.multiply.accumulate(x))
    return both[0], both[1]


def string_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, numbers=_grams, gram: int = GRAM) -> np.ndarray:
    """Hash of the bytes from each start to each end, eight at least, from sums over the hashes of all eight bytes in a row.

    Or of other things than bytes, ``gram`` at least, from the ``numbers`` of each ``gram`` of them.
    """
    out = np.zeros(len(start), _U)
    if not len(start):
        return out
    size = SEGMENT + max(1024, 1 << (int((end - start).max()) - 1).bit_length())
    up, down = _powers(size)
    of = start // SEGMENT
    order = np.argsort(of, kind="stable")
    edges = np.flatnonzero(np.diff(of[order], prepend=-1)).tolist() + [len(order)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        here = order[a:b]
        low = int(of[here[0]]) * SEGMENT
        grams = numbers(data[low : low + size])
        sums = np.zeros(len(grams) + 1, _U)
        np.cumsum(grams * up[: len(grams)], out=sums[1:])
        i, j = start[here] - low, end[here] - low - (gram - 1)
        out[here] = _mixed((sums[j] - sums[i]) * down[i])
    return out


def _dealt(keys: np.ndarray, tasks: int) -> Iterator[tuple[int, int, int]]:
    """Of sorted keys the range that goes to each task; no range without keys."""
    task = ((keys >> _U(32)) * _U(tasks)) >> _U(32)
    edges = np.flatnonzero(np.diff(task.astype(np.int64), prepend=-1)).tolist() + [len(keys)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(task[a]), a, b


# -- passages of words -------------------------------------------------------------


def _words(data: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the joined texts, and how many words they have up to each text's end."""
    bounds = np.cumsum([0, *lengths])
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    blank = (data == 0x20) | ((data >= 9) & (data <= 13))
    start = np.flatnonzero(~blank & (edge[:-1] | np.append(True, blank[:-1])))
    end = np.flatnonzero(~blank & (edge[1:] | np.append(blank[1:], True))) + 1
    return string_hashes(data, start, end, _bytes, 1), np.searchsorted(start, bounds[1:])


def _plain(hashes: np.ndarray) -> np.ndarray:
    return hashes


def _windows(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First word of each window, the number of its anchor, and per anchor the hash of the words that its windows share, and its text."""
    counts = np.diff(ends, prepend=0)
    n = np.maximum(counts - WORDS + 1, 0)
    if not n.sum():
        none = np.zeros(0, np.int64)
        return none, none, none.view(_U), none
    owner = np.repeat(np.arange(len(n)), n)
    start = np.arange(len(owner)) + np.repeat(ends - counts - (np.cumsum(n) - n), n)
    # Three words, as single ones come back too soon.
    threes = _mixed((words[:-2] * _U(31) + words[1:-1]) * _U(31) + words[2:])
    at = _lowest(threes, WORD_SPAN)[start]
    new = np.diff(at, prepend=-1) != 0
    own = at[new]
    return start, np.cumsum(new) - 1, string_hashes(words, own, own + (WORDS - WORD_SPAN + 1), _plain, 1), owner[new]


def _distinct(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys, whether two texts hold each, and which one each is; owners ascend."""
    found, of = np.unique(keys, return_inverse=True)
    first, last = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
    last[of] = owner
    first[of[::-1]] = owner[::-1]
    return found, first != last, of


# -- slices ------------------------------------------------------------------------


def _slices(docs: DataFrame, length: int, span: int, slice_bytes: int) -> DataFrame:
    """Texts of ``id``, ``text`` documents in slices, with the chunks of those of ``length`` bytes and more.

    ``marks`` holds per text in it: its number, and how many positions and anchors with strings it has; per position its place in
    the slice, its chunk's hash, how many chunks an anchor's strings have in common (0 for those without), and the offsets of the
    nearest and the farthest string start before it. ``cores`` holds
    the hashes of the words that windows of one anchor share, and whether two texts have them.
    """
    schema = schema_of(
        slice="long", ids=ArrayType(docs.schema["id"].dataType), lengths="array<int>", data="binary", digests="binary", marks="binary", positions="long",
        cores="binary", words="long",
    )
    out = to_arrow_schema(schema)

    def send(number: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
        joined = np.frombuffer(b"".join(texts), np.uint8)
        lengths = [len(t) for t in texts]
        starts = np.cumsum([0, *lengths[:-1]])
        owners, counts, places, stops, runs, near, far = [], [], [], [], [], [], []
        for k, text in enumerate(texts):
            at, first, last = anchors(text, length, span)
            if not len(at):
                continue
            n = len(at) - 1  # the last one ends a chunk only
            bearing = min(len(first), n)
            own = at[:bearing]
            run = np.zeros(n, np.int64)
            run[:bearing] = np.searchsorted(at, own + (length - 2 * span + 1 - GRAM), "right") - np.arange(bearing)
            offsets = np.zeros((2, n), np.int64)
            offsets[:, :bearing] = own - last[:bearing], own - first[:bearing]
            owners.append(k)
            counts.append(n)
            places.append(at[:-1] + starts[k])
            stops.append(at[1:] + starts[k])
            runs.append(run)
            near.append(offsets[0])
            far.append(offsets[1])
        joint = {"at": places, "run": runs, "near": near, "far": far}
        marks = {c: np.concatenate(x) if x else np.zeros(0, np.int64) for c, x in joint.items()}
        stop = np.concatenate(stops) if stops else np.zeros(0, np.int64)
        name = string_hashes(joined, marks["at"], stop + GRAM - 1)
        small = {"run": marks["run"].astype(np.int16), "near": marks["near"].astype(np.int16), "far": marks["far"].astype(np.int16)}
        blob = pack_all(owner=np.array(owners, np.int64), n=np.array(counts, np.int64), at=np.diff(marks["at"], prepend=0), name=name, **small)
        digests = np.frombuffer(b"".join(hashlib.sha256(t).digest() for t in texts), np.uint8)
        words, ends = _words(joined, lengths)
        cores, many, _ = _distinct(*_windows(words, ends)[2:])
        row = (number, ids, lengths, pack(joined), pack(digests), blob, len(name), pack_all(keys=cores, many=many), len(words))
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, out, strict=True)], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(key)
                texts.append((text.as_py() or "").encode())
                size += len(texts[-1]) + 1
                if size >= slice_bytes:
                    yield send(number, ids, texts)
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield send(number, ids, texts)

    return stored(docs.select("id", "text").mapInArrow(run, schema), "text-slices")


ANSWER = dict(slice="long", q="int", answer="binary")
MIXED = dict(slice="long", state="binary", waiting="long", q="int", ask="binary")


def _copies(slices: DataFrame, length: int, tasks: int) -> DataFrame:
    """For each slice the numbers of texts that have copies (``copied``), and of those to leave out, as another stands for them."""
    asked, answered = schema_of(q="int", slice="long", ask="binary"), schema_of(**ANSWER)
    out = to_arrow_schema(asked)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(pa.Table.from_batches([batch])):
                number = np.flatnonzero(np.array(row["lengths"]) >= length)
                digest = unpack(row["digests"], "S32")[number] if len(number) else np.zeros(0, "S32")
                head = np.frombuffer(unpack(row["digests"], np.uint8).tobytes(), ">u8")[::4][number].astype(_U)
                order = np.argsort(head, kind="stable")
                number, digest, head = number[order], digest[order], head[order]
                for q, a, b in _dealt(head, tasks):
                    one = (q, row["slice"], pack_all(number=number[a:b], digest=digest[a:b]))
                    yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(one, out, strict=True)], schema=out)

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(((r["slice"], unpack_all(r["ask"])) for r in rows_of(table)), key=lambda r: r[0])
        all_digests = np.concatenate([x["digest"] for _, x in rows])
        _, first, of, count = np.unique(all_digests, return_index=True, return_inverse=True, return_counts=True)
        copied, later = count[of] > 1, first[of] != np.arange(len(of))
        result, at = [], 0
        for s, x in rows:
            here = slice(at, at + len(x["number"]))
            at += len(x["number"])
            result.append((s, key[0].as_py(), pack_all(copied=x["number"][copied[here]], later=x["number"][later[here]])))
        return table_of(result, answered)

    asks = slices.select("slice", "lengths", "digests").mapInArrow(ask, asked)
    return stored(asks.groupBy("q").applyInArrow(answer, answered), "copies")


# -- prefix doubling ---------------------------------------------------------------


def _pairs(state: dict[str, np.ndarray], level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions whose runs get a rank this round, how many of them take part in later rounds too (first), and their keys."""
    rank, run, stop = state["rank"], state["run"], state["stop"]
    if not level:
        return np.arange(len(rank)), np.array(len(rank)), state["name"]
    half = 1 << level - 1
    alive = np.flatnonzero(rank >= 0)
    full = alive[alive + 2 * half <= stop[alive]]
    full = full[rank[full + half] >= 0]
    last = alive[(run[alive] > half) & (run[alive] < 2 * half)]
    last = last[rank[last + run[last] - half] >= 0]
    keys = [_key(rank[full], rank[full + half], np.zeros(len(full))), _key(rank[last], rank[last + run[last] - half], run[last])]
    return np.concatenate([full, last]), np.array(len(full)), np.concatenate(keys)


def _asked(number: int, found: np.ndarray, many: np.ndarray, tasks: int, waiting: int | None = None) -> list[tuple]:
    return [
        (number, None, waiting, q, pack_all(keys=np.diff(found[a:b], prepend=_U(0)), many=many[a:b])) for q, a, b in _dealt(found, tasks)
    ]


def _asks(number: int, keys: np.ndarray, tasks: int) -> list[tuple]:
    found, counts = np.unique(keys, return_counts=True)
    return _asked(number, found, counts > 1, tasks)


def _again(asks: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Of the different keys that slices ask for, whether each occurs twice or more in all, and which one each is."""
    found, of, count = np.unique(np.concatenate([np.cumsum(x["keys"], dtype=_U) for x in asks]), return_inverse=True, return_counts=True)
    again = count > 1
    again[of[np.concatenate([x["many"] for x in asks])]] = True
    return again, of


def _ranker(level: int):
    """Ranks of the keys dealt to a task, in their order; -1 for those that occur once in all."""
    answered = schema_of(**ANSWER)

    def rank(key: tuple, table: pa.Table) -> pa.Table:
        rows = [(r["slice"], unpack_all(r["ask"])) for r in rows_of(table)]
        again, of = _again([x for _, x in rows])
        ranks = np.where(again, np.arange(len(again)) + (level << 58 | key[0].as_py() << 32), -1)[of]
        out, at = [], 0
        for s, x in rows:
            out.append((s, key[0].as_py(), pack(ranks[at : at + len(x["keys"])])))
            at += len(x["keys"])
        return table_of(out, answered)

    return rank


def _joined(answers: list[dict], kind: type) -> np.ndarray:
    parts = [unpack(r["answer"], kind) for r in sorted(answers, key=lambda r: r["q"])]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _first_state(tasks: int):
    mixed = schema_of(**MIXED)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in rows_of(left):
            marks, answers = unpack_all(row["marks"]), [unpack_all(r["answer"]) for r in rows_of(right)]
            copied, later = (np.concatenate([a[c] for a in answers] or [np.zeros(0, np.int64)]) for c in ("copied", "later"))
            stay = ~np.isin(marks["owner"], later)
            positions = np.repeat(stay, marks["n"])
            n = marks["n"][stay]
            state = {
                "copied": copied, "stop": np.repeat(np.cumsum(n), n), "at": np.cumsum(marks["at"])[positions], "name": marks["name"][positions],
                "run": marks["run"][positions].astype(np.int64), "near": marks["near"][positions], "far": marks["far"][positions],
                "found": np.zeros(0, np.int64), "found_name": np.zeros(0, np.int64), "rank": np.full(int(n.sum()), -1, np.int64),
            }
            out += [(row["slice"], pack_all(**state), len(state["at"]), None, None), *_asks(row["slice"], state["name"], tasks)]
        return table_of(out, mixed)

    return run


def _doubled(level: int, tasks: int):
    """Takes in the ranks of a round and asks for those of the next."""
    mixed = schema_of(**MIXED)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in rows_of(left):
            state = unpack_all(row["state"])
            places, full, keys = _pairs(state, level)
            _, of = np.unique(keys, return_inverse=True)
            answers = _joined(list(rows_of(right)), np.int64)
            # A slice without anchors that wait has not asked; equal strings have equal runs, so none waits for it either.
            ranks = answers[of] if len(answers) else np.full(len(keys), -1, np.int64)
            full = int(full)
            state["rank"] = np.full(len(state["at"]), -1, np.int64)
            state["rank"][places[:full]] = ranks[:full]
            run, done = state["run"][places], 1 << level
            whole = (ranks >= 0) & np.where(np.arange(len(places)) < full, run == done, True)
            state["found"] = np.concatenate([state["found"], places[whole]])
            state["found_name"] = np.concatenate([state["found_name"], ranks[whole]])
            waiting = int(((state["run"] > done) & (state["rank"] >= 0)).sum())
            if not level:
                del state["name"]
            out.append((row["slice"], pack_all(**state), waiting, None, None))
            if waiting:
                out += _asks(row["slice"], _pairs(state, level + 1)[2], tasks)
        return table_of(out, mixed)

    return run


# -- passages: keys that two texts hold ----------------------------------------------

PASSAGE = -1  # ``waiting`` of rows that concern passages of words


def _cores(slices: DataFrame, tasks: int) -> DataFrame:
    mixed = schema_of(**MIXED)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(pa.Table.from_batches([batch])):
                cores = unpack_all(row["cores"])
                yield from table_of(_asked(row["slice"], cores["keys"], cores["many"], tasks), mixed).to_batches()

    return slices.select("slice", "cores").mapInArrow(ask, mixed)


def _sharer():
    """Whether two texts hold each key dealt to a task."""
    answered = schema_of(**ANSWER)

    def share(key: tuple, table: pa.Table) -> pa.Table:
        rows = [(r["slice"], unpack_all(r["ask"])) for r in rows_of(table)]
        again, of = _again([x for _, x in rows])
        ends = np.cumsum([len(x["keys"]) for _, x in rows])
        parts = np.split(again[of].astype(np.uint8), ends[:-1])
        return table_of([(s, key[0].as_py(), pack(part)) for (s, _), part in zip(rows, parts, strict=True)], answered)

    return share


def _passages(texts: dict, answers: list[dict], tasks: int) -> list[tuple]:
    """Asks for the windows of words whose anchors have their core in another text; a row keeps where they are."""
    words, ends = _words(unpack(texts["data"], np.uint8), texts["lengths"])
    start, of, core, _ = _windows(words, ends)
    if len(core):
        _, core = np.unique(core, return_inverse=True)
        start = start[(_joined(answers, np.uint8)[core] > 0)[of]]
    keys = string_hashes(words, start, start + WORDS, _plain, 1)
    found, many, which = _distinct(keys, np.searchsorted(ends, start, "right"))
    state = pack_all(start=np.diff(start, prepend=0), which=which.astype(np.uint32), ends=ends)
    return [(texts["slice"], state, PASSAGE, None, None), *_asked(texts["slice"], found, many, tasks, PASSAGE)]


COUNTED = dict(slice="long", passages="binary")


def _counter():
    counted = schema_of(**COUNTED)

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        """Of each text of a slice how many words lie in windows that another text holds."""
        out = []
        for row in rows_of(left):
            state, shared = unpack_all(row["state"]), _joined(list(rows_of(right)), np.uint8)
            hit = np.cumsum(state["start"])[shared[state["which"]] > 0]
            fresh = np.minimum(np.diff(hit, append=hit[-1:] + WORDS), WORDS)
            counts = np.bincount(np.searchsorted(state["ends"], hit, "right"), fresh, len(state["ends"]))
            out.append((row["slice"], pack(counts.astype(np.int64))))
        return table_of(out, counted)

    return count


# -- matches -----------------------------------------------------------------------


def _blocks(data: np.ndarray, todo: dict[str, np.ndarray], length: int, width: int) -> dict[str, np.ndarray]:
    """The strings of some anchors in blocks of ``width`` offsets.

    A block is known by the bytes that all strings with its offsets share
    (``core``) and by those that the anchor's own strings there cover together.
    """
    first, last = todo["near"] // width, todo["far"] // width
    of = np.repeat(np.arange(len(first)), last - first + 1)
    block = np.arange(len(of)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1) + first[of]
    at, low = todo["at"][of], block * width
    near, far = np.maximum(low, todo["near"][of]), np.minimum(low + width - 1, todo["far"][of])
    core = string_hashes(data, at - low, at - low - width + 1 + length)
    cover = core if width == 1 else string_hashes(data, at - far, at - near + length)
    return {
        "core": _key(todo["name"][of], block, core.view(np.int64)), "cover": _key(near, far, cover.view(np.int64)),
        "at": at, "near": near, "far": far, "name": todo["name"][of], "open": todo["open"][of],
    }


def _grouped(blocks: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and number of the equal blocks of a slice, by core and cover, and which group each is in."""
    order = np.lexsort((blocks["cover"], blocks["core"]))
    core, cover = blocks["core"][order], blocks["cover"][order]
    new = np.ones(len(order), bool)
    new[1:] = (core[1:] != core[:-1]) | (cover[1:] != cover[:-1])
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    return order[new], np.bincount(of, minlength=int(new.sum())), of


REPEATED, CUT, CUT_OPEN = 1, 2, 4


def _comparer():
    answered = schema_of(**ANSWER)

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        """What becomes of each group of blocks: repeated, and whether its bearer is cut further, with strings still open."""
        # By slice, so that a task that is run again names the same bearers.
        rows = sorted(((r["slice"], unpack_all(r["ask"])) for r in rows_of(table)), key=lambda r: r[0])
        core, cover = (np.concatenate([x[c] for _, x in rows]) for c in ("core", "cover"))
        many, is_open = (np.concatenate([x[c] for _, x in rows]) for c in ("many", "open"))
        order = np.lexsort((cover, core))
        new = np.ones(len(order), bool)
        new_core = new.copy()
        new_core[1:] = core[order][1:] != core[order][:-1]
        new[1:] = new_core[1:] | (cover[order][1:] != cover[order][:-1])
        of = np.empty(len(order), np.int64)
        of[order] = np.cumsum(new) - 1
        first = order[new]
        size = int(new.sum())
        twice = np.bincount(of, minlength=size) > 1
        twice[of[many]] = True
        opened = np.zeros(size, bool)
        opened[of[is_open]] = True
        alone = ~twice & opened
        group = (np.cumsum(new_core) - 1)[new]
        mixed = (np.bincount(group) > 1) & (np.bincount(group, alone) > 0)
        code = np.where(twice[of], REPEATED, 0)
        bearer = first[mixed[group]]
        code[bearer] |= CUT
        code[first[mixed[group] & alone]] |= CUT_OPEN
        out, at = [], 0
        for s, x in rows:
            out.append((s, key[0].as_py(), pack(code[at : at + len(x["core"])].astype(np.uint8))))
            at += len(x["core"])
        return table_of(out, answered)

    return compare


def _taken_in(state: dict[str, np.ndarray], answers: list[dict]) -> dict[str, np.ndarray]:
    """Hits of the last comparison, and what is left to be cut."""
    first, _, of = _grouped(state)
    code = _joined(answers, np.uint8)
    hit = (code[of] & REPEATED > 0) & state["open"]
    low, high = state["at"] - state["far"], state["at"] - state["near"]
    left = first[code & CUT > 0]
    todo = {c: state[c][left] for c in ("at", "near", "far", "name")}
    return todo | {
        "open": code[code & CUT > 0] & CUT_OPEN > 0, "copied": state["copied"],
        "low": np.concatenate([state["low"], low[hit]]), "high": np.concatenate([state["high"], high[hit]]),
    }


def _cutter(level: int, length: int, tasks: int, word_tasks: int):
    """Takes in a comparison and asks for the next, of smaller blocks; at first, also for passages of words."""
    mixed = schema_of(**MIXED)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        states, answers = [], []
        for row in rows_of(right):
            (answers if row["state"] is None else states).append(row)
        out = []
        for row, texts in zip(states, rows_of(left), strict=True):
            state = unpack_all(row["state"])
            if level:
                todo = _taken_in(state, answers)
            else:
                none = np.zeros(0, np.int64)
                todo = {c: state[c][state["found"]].astype(np.int64) for c in ("at", "near", "far")} | {
                    "name": state["found_name"], "open": np.ones(len(state["found"]), bool), "copied": state["copied"], "low": none, "high": none,
                }
                out += _passages(texts, answers, word_tasks)
            blocks = _blocks(unpack(texts["data"], np.uint8), todo, length, WIDTHS[level])
            out.append((row["slice"], pack_all(**(todo | blocks)), len(blocks["at"]), None, None))
            first, counts, _ = _grouped(blocks)
            core, cover, many = blocks["core"][first], blocks["cover"][first], counts > 1
            opened = np.bincount(_grouped(blocks)[2], blocks["open"], minlength=len(first)) > 0
            for q, a, b in _dealt(core, tasks):
                out.append((row["slice"], None, None, q, pack_all(core=core[a:b], cover=cover[a:b], many=many[a:b], open=opened[a:b])))
        return table_of(out, mixed)

    return run


def _cut_spans(text: bytes, spans: list[list[int]]) -> tuple[int, list[list[int]], str]:
    kept, at = hashlib.sha256(), 0
    for low, high in spans:
        kept.update(text[at:low])
        at = high
    kept.update(text[at:])
    return sum(b - a for a, b in spans), spans, kept.hexdigest()


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, span: int = SPAN, slice_bytes: int = SLICE_BYTES, keys: int = KEYS
) -> DataFrame:
    """One row per document: ``id``, ``n_bytes``, ``n_removed``, ``spans`` (byte ranges), ``kept_sha256``, ``n_passage_words``."""
    slices = _slices(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), length, span, slice_bytes)
    positions, texts, words = (int(x or 0) for x in slices.agg(F.sum("positions"), F.sum(F.size("ids")), F.sum("words")).first())
    tasks, word_tasks = 1 + positions // keys, 1 + words // (4 * keys)  # few windows of words get as far as to be compared
    mixed_schema, answer_schema = schema_of(**MIXED), schema_of(**ANSWER)

    def parted(mixed: DataFrame) -> tuple[DataFrame, DataFrame]:
        mixed = mixed.filter(f"coalesce(waiting, 0) != {PASSAGE}")
        return mixed.filter("q is null").select("slice", "state"), mixed.filter("q is not null").select("q", "slice", "ask")

    copies = _copies(slices, length, 1 + texts // keys)
    both = slices.select("slice", "marks").groupBy("slice").cogroup(copies.groupBy("slice"))
    mixed, level = stored(both.applyInArrow(_first_state(tasks), mixed_schema), "ranks"), 0
    dropped(copies)
    while True:
        states, asks = parted(mixed)
        answers = asks.groupBy("q").applyInArrow(_ranker(level), answer_schema)
        before, doubled = mixed, states.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(_doubled(level, tasks), mixed_schema)
        mixed = stored(doubled, "ranks")
        dropped(before)
        if not mixed.agg(F.sum("waiting")).first()[0]:
            break
        level += 1
    states = parted(mixed)[0].withColumn("answer", F.lit(None).cast("binary")).withColumn("q", F.lit(None).cast("int"))
    states = states.unionByName(_cores(slices, tasks).groupBy("q").applyInArrow(_sharer(), answer_schema), allowMissingColumns=True)
    data = slices.select("slice", "lengths", "data").groupBy("slice")
    for level in range(len(WIDTHS)):
        before, cut = mixed, data.cogroup(states.groupBy("slice")).applyInArrow(_cutter(level, length, tasks, word_tasks), mixed_schema)
        mixed = stored(cut, "blocks")
        if not level:
            found = mixed.filter(f"waiting = {PASSAGE}")
            shared = found.filter("q is not null").groupBy("q").applyInArrow(_sharer(), answer_schema)
            both = found.filter("q is null").groupBy("slice").cogroup(shared.groupBy("slice"))
            passages = stored(both.applyInArrow(_counter(), schema_of(**COUNTED)), "passages")
        dropped(before)
        states, asks = parted(mixed)
        answers = asks.groupBy("q").applyInArrow(_comparer(), answer_schema)
        states = states.unionByName(answers, allowMissingColumns=True)

    id_type = docs.schema[id_col].dataType
    schema = schema_of(id=id_type, n_bytes="long", n_removed="long", spans="array<array<long>>", kept_sha256="string", n_passage_words="long")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        found, answers, counts, out = [], [], [], []
        for row in rows_of(right):
            (counts if row["passages"] is not None else answers if row["state"] is None else found).append(row)
        for row, count, texts in zip(found, counts, rows_of(left), strict=True):
            state = _taken_in(unpack_all(row["state"]), answers)
            joined, lengths = unpack(texts["data"], np.uint8).tobytes(), texts["lengths"]
            begins = np.cumsum([0, *lengths[:-1]])
            order = np.argsort(state["low"], kind="stable")
            low, high = state["low"][order], np.maximum.accumulate(state["high"][order] + length) if len(order) else order
            own = np.searchsorted(begins, low, "right") - 1
            # A span begins where no earlier one of its text reaches.
            new = np.ones(len(low), bool)
            new[1:] = (low[1:] > high[:-1]) | (own[1:] != own[:-1])
            starts = np.flatnonzero(new)
            ends = high[np.append(starts[1:], len(low)) - 1] if len(low) else high
            spans: dict[int, list] = {}
            for k, a, b in zip(own[starts].tolist(), low[starts].tolist(), ends.tolist(), strict=True):
                spans.setdefault(k, []).append([a - int(begins[k]), b - int(begins[k])])
            spans |= {int(k): [[0, lengths[k]]] for k in state["copied"]}
            in_passages = unpack(count["passages"], np.int64).tolist()
            for k, (key, n) in enumerate(zip(texts["ids"], lengths, strict=True)):
                begin = int(begins[k])
                out.append((key, n, *_cut_spans(joined[begin : begin + n], spans.get(k, [])), in_passages[k]))
        return table_of(out, schema)

    states = states.unionByName(passages, allowMissingColumns=True)
    return slices.select("slice", "ids", "lengths", "data").groupBy("slice").cogroup(states.groupBy("slice")).applyInArrow(finish, schema)
