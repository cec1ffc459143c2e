"""SentencePiece encoding by sampling without replacement, and decoding.

A text's lattice has every way to spell it in pieces of a public vocabulary;
characters that are no piece are spelled in bytes. The files give merge ranks,
no probabilities, so a piece of rank r weighs 1 / (r + ``SHIFT``) (nothing is
trained); a segmentation's probability is its product of weights over the sum
of all. Pieces never cross the space before a word or a line feed, so the
lattice is a chain of units, and every distinct unit of a batch is worked out
once: backward sums give each place the probabilities of its next piece.

Gumbel top-k: the root of the tree of all segmentations gets a Gumbel value, the
best leaf has the same. A path goes down by sampling the next piece; at every
place the pieces not taken form one unexplored subtree, whose value is a Gumbel
of its mass, truncated at the path's. These subtrees are the agenda of an A*
search with perturbed values as bounds: the best is split, its path goes down
afresh, and its remainder goes back. Paths come out in falling order, all
distinct, with probabilities as if drawn one by one without replacement. The
(k+1)-th value gives each its inclusion score, log(1 - exp(-exp(log_prob -
value))), 0 where nothing was left out.

Random numbers are hashes of seed, row key, path and place in the text, so a
row's samples depend on neither partitions nor neighbours; rows of one key and
text get the same ones, null keys count as one key. Null and empty texts have
one segmentation, without pieces; texts with fewer than k give all they have.
Very long texts are worked out alone, in memory of about 100 bytes a character.
Decoding gives back the exact text, literal U+2581 included. Extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType

from kliping.llm.shared import map_slices, schema_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
SHIFT = 10.0
GROUP = 1_800_000  # characters worked out together
ROWS = 1024  # encoded in one slice
DECODED = 64  # rows decoded in one slice
MARK = "▁"  # stands for a space in pieces

TABLE_BITS = 18  # of the trie's hash table, some times the transitions of a usual vocabulary
TABLE = 1 << TABLE_BITS

_U = np.uint64
_GAMMA = _U(0x9E3779B97F4A7C15)


def _uniform(seed: np.ndarray, place: np.ndarray, path: int, purpose: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on the arguments only."""
    x = seed + (place.astype(np.uint64) + _U((path * 4 + purpose) << 40)) * _GAMMA
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    x = x ^ (x >> _U(31))
    return ((x >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53


def _truncated(mass: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values of these log masses, conditioned to lie below the bounds."""
    with np.errstate(divide="ignore"):
        return -np.logaddexp(-bound, np.log(-np.log(u)) - mass)


def _slots(key: np.ndarray) -> np.ndarray:
    return ((key.astype(np.uint64) * _GAMMA) >> _U(64 - TABLE_BITS)).astype(np.int64)


@dataclass
class Vocabulary:
    """A trie over the pieces: ``keys`` (state, character) in a hash table, the states they lead to, and per state piece and weight."""

    pieces: list[str]
    keys: np.ndarray
    to: np.ndarray
    probes: int
    piece: np.ndarray
    weight: np.ndarray
    byte_ids: list[int]
    byte_weight: float

    @staticmethod
    def load(model_file: str = MODEL) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        scores = [model.get_score(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        ranks = {i: max(0.0, -scores[i]) for i in plain if scores[i] > -1e8}
        last = max(ranks.values())
        ranks = {i: ranks.get(i, last) for i in plain}
        states: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        for i in plain:
            at = 0
            for c in pieces[i]:
                at = states.setdefault((at, ord(c)), len(states) + 1)
            ends[at] = i
        keys, to, probes = np.full(TABLE, -1, np.int64), np.zeros(TABLE, np.int64), 1
        for (a, c), state in states.items():
            key, n = (a << 21) | c, 1
            slot = int(_slots(np.array([key]))[0])
            while keys[slot] >= 0:
                slot, n = (slot + 1) % TABLE, n + 1
            keys[slot], to[slot], probes = key, state, max(probes, n)
        piece = np.full(len(states) + 1, -1, np.int32)
        weight = np.zeros(len(states) + 1)
        for state, i in ends.items():
            piece[state], weight[state] = i, -np.log(ranks[i] + SHIFT)
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        return Vocabulary(pieces, keys, to, probes, piece, weight, byte_ids, -np.log(last + SHIFT + 1))

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The states that these characters lead to, 0 where no piece goes on so."""
        key = (state << 21) | code
        slot = _slots(key)
        seen = self.keys[slot]
        met = seen == key
        out = np.where(met, self.to[slot], 0)
        open_ = np.flatnonzero(~met & (seen >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) % TABLE
            seen = self.keys[slot[open_]]
            hit = open_[seen == key[open_]]
            out[hit] = self.to[slot[hit]]
            open_ = open_[(seen != key[open_]) & (seen >= 0)]
        return out

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode()

    def decode_bytes(self, ids: list[int]) -> bytes:
        """The text in UTF-8."""
        return b"".join(map(self._spelled().__getitem__, ids))[1:]

    def checksums(self, pieces: list[np.ndarray]) -> list[int]:
        """CRC-32 of the texts in UTF-8 that these pieces decode to."""
        if not pieces:
            return []
        spelled = pa.array(self._spelled(), pa.large_binary()).take(pa.array(np.concatenate(pieces)))
        _, offsets, data = spelled.buffers()
        ends = np.frombuffer(offsets, np.int64)[np.cumsum([0, *map(len, pieces)])].tolist()
        data = memoryview(data or b"")
        return [zlib.crc32(data[a + 1 : b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def _spelled(self) -> list[bytes]:
        if not hasattr(self, "_bytes"):
            self._bytes = [p.replace(MARK, " ").encode() for p in self.pieces]
            for b, i in enumerate(self.byte_ids):
                self._bytes[i] = bytes([b])
        return self._bytes


def _units(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The units of all texts behind one another, and how many each has.

    A unit is a line feed, or a run of spaces with the characters up to the next space or line feed. A space is put before
    each text; empty ones have no units.
    """
    encoded = [(" " + t).encode() if t else b"" for t in texts]
    data = np.frombuffer(b"".join(encoded), np.uint8)
    sizes = np.array([len(x) for x in encoded], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    line, space = data == 0x0A, data == 0x20
    begins = line.copy()
    begins[1:] |= line[:-1] | (space[1:] & ~space[:-1])
    begins[starts[starts < len(data)]] = True
    at = np.append(np.flatnonzero(begins), len(data))
    units = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data)).dictionary_encode()
    return units, np.diff(np.searchsorted(at[:-1], ends), prepend=0)


class Lattices:
    """The lattices of distinct units, one place per character, edges sorted by place."""

    def __init__(self, units: pa.LargeStringArray, vocabulary: Vocabulary) -> None:
        lengths = pc.utf8_length(units).to_numpy(zero_copy_only=False).astype(np.int64)
        self.stop = np.cumsum(lengths)
        self.start = self.stop - lengths
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(units)], units), pa.scalar("", units.type))[0].as_py()
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        literal = codes == ord(MARK)
        codes = np.where(codes == 0x20, ord(MARK), codes)
        codes[literal] = (1 << 21) - 1  # no piece has it, so it is spelled in bytes
        stop = np.repeat(self.stop, lengths).astype(np.int32)
        places = np.arange(len(codes), dtype=np.int32)
        edges: list[tuple[np.ndarray, ...]] = []
        at, state, depth = places, np.zeros(len(codes), np.int64), 0
        single = np.zeros(len(codes), bool)
        while len(at):
            state = vocabulary.step(state, codes[at + depth])
            known = state > 0
            at, state, depth = at[known], state[known], depth + 1
            piece = vocabulary.piece[state]
            ends = np.flatnonzero(piece >= 0)
            begin = at[ends]
            edges.append((begin, begin + depth, piece[ends], vocabulary.weight[state[ends]]))
            if depth == 1:
                single[begin] = True
            more = at + depth < stop[at]
            at, state = at[more], state[more]
        rest = places[~single]
        codes = np.where(literal, ord(MARK), codes)[rest]
        # Negative pieces are characters in several bytes.
        n_bytes = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        one = np.array(vocabulary.byte_ids)[np.minimum(codes, 0xFF)]
        edges.append((rest, rest + 1, np.where(n_bytes == 1, one, -codes - 1), n_bytes * vocabulary.byte_weight))
        source, self.target, self.piece, weight = (np.concatenate(x) for x in zip(*edges, strict=True))
        edges.clear()
        order = np.argsort(source, kind="stable")
        source, self.target, self.piece, weight = (x[order] for x in (source, self.target, self.piece, weight))
        many = np.bincount(source, minlength=len(places))
        self.first = np.concatenate([[0], np.cumsum(many)])
        self.ends = self.target == stop[source]
        # Sums over all ways from a place to its unit's end, from the end backwards.
        sums = np.zeros(len(places) + 1)
        left = (stop - places)[source]
        if left.max(initial=0) < 1 << 16:
            left = left.astype(np.uint16)  # sorted by digits
        by_left = np.argsort(left, kind="stable")
        bounds = np.cumsum(np.bincount(left))
        onward = np.where(self.ends, len(places), self.target)[by_left]  # the last sum stays 0
        ways, own = weight[by_left], source[by_left]
        heads = np.flatnonzero(np.diff(own, prepend=-1))
        own = own[heads]
        head_bounds = np.searchsorted(heads, bounds)
        for a, b, c, d in zip(bounds[:-1], bounds[1:], head_bounds[:-1], head_bounds[1:], strict=True):
            if b > a:
                ways[a:b] += sums[onward[a:b]]
                sums[own[c:d]] = np.logaddexp.reduceat(ways[a:b], heads[c:d] - a)
        total = np.empty(len(source))
        total[by_left] = ways
        self.log_share = total - np.repeat(sums[:-1], many)
        share = np.exp(self.log_share)
        running = np.cumsum(share)
        before = (running - share)[self.first[:-1]]
        inside = np.minimum(running - np.repeat(before, many), 1.0)
        inside[self.first[1:] - 1] = 1.0
        self.reach = source + inside  # of place + u, the first edge that reaches it is drawn
        with np.errstate(divide="ignore"):
            self.log_rest = np.where(np.repeat(many, many) > 1, np.log1p(-np.minimum(share, 1 - 1e-16)), -np.inf)

    def drawn(self, place: np.ndarray, u: np.ndarray) -> np.ndarray:
        edge = self.first[place]
        goal = place + u
        # A place's last edge reaches the next place, and no goal lies beyond.
        short = np.flatnonzero(self.reach[edge] < goal)
        while len(short):
            edge[short] += 1
            short = short[self.reach[edge[short]] < goal[short]]
        return edge


@dataclass
class Path:
    """Edges of a whole path, log probabilities before each and behind the last; values of the subtrees left at steps from ``begin`` on."""

    edges: np.ndarray
    units: np.ndarray
    before: np.ndarray
    value: float
    begin: int
    left: np.ndarray
    taken: dict[int, list[int]]

    def best(self) -> tuple[float, int]:
        if not len(self.left):
            return -np.inf, -1
        at = int(self.left.argmax())
        return float(self.left[at]), self.begin + at


class Sampler:
    """Samples the segmentations of a group of texts."""

    def __init__(self, texts: list[str], seeds: list[int], vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        units, self.count = _units(texts)
        self.units = units.indices.to_numpy().astype(np.int64)
        self.end = np.cumsum(self.count)
        self.doc = np.repeat(np.arange(len(texts)), self.count)
        self.seed = np.array(seeds, np.uint64)
        if len(units):
            self.lattices = Lattices(units.dictionary, vocabulary)
            size = (self.lattices.stop - self.lattices.start)[self.units]
            # Place of each unit in its text.
            place = np.cumsum(size) - size
            begins = self.end - self.count
            self.offset = place - place[np.minimum(begins, len(place) - 1)][self.doc]

    def descend(self, unit: np.ndarray, place: np.ndarray, path: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Edges drawn from these places to the ends of their units, in order, with units (in the group) and places in the text."""
        lat, edges, owners, spots = self.lattices, [], [], []
        which = np.arange(len(unit))
        while len(which):
            own = unit[which]
            spot = self.offset[own] + place - lat.start[self.units[own]]
            e = lat.drawn(place, _uniform(self.seed[self.doc[own]], spot, path, 0))
            edges.append(e), owners.append(which), spots.append(spot)
            on = ~lat.ends[e]
            which, place = which[on], lat.target[e[on]]
        order = np.argsort(np.concatenate(owners), kind="stable") if owners else np.zeros(0, np.int64)
        e, own, spot = (np.concatenate(x)[order] if x else np.zeros(0, np.int64) for x in (edges, owners, spots))
        return e, unit[own] if len(own) else own, spot

    def _grown(self, starts: list[tuple], path: int) -> None:
        """Finish a path for each (document, value, edges and units so far, log probability, taken, units and places to go on from)."""
        lat = self.lattices
        e, unit, spot = self.descend(
            np.concatenate([s[5] for s in starts]), np.concatenate([s[6] for s in starts]), path
        )
        doc = self.doc[unit]
        bounds = np.searchsorted(doc, [s[0] for s in starts]), np.searchsorted(doc, [s[0] for s in starts], "right")
        share = lat.log_share[e]
        running = np.cumsum(share)
        base = np.zeros(len(self.count))
        value = np.zeros(len(self.count))
        for s, a in zip(starts, bounds[0], strict=True):
            base[s[0]] = s[4] - (running[a - 1] if a else 0.0)
            value[s[0]] = s[1]
        before = running - share + base[doc]
        left = _truncated(before + lat.log_rest[e], value[doc], _uniform(self.seed[doc], spot, path, 1))
        for s, a, b in zip(starts, *bounds, strict=True):
            d, v, past_edges, past_units, log, _, _, past_before = s
            whole = np.concatenate([past_before, before[a:b], [before[b - 1] + share[b - 1] if b > a else log]])
            self.paths[d].append(
                Path(np.concatenate([past_edges, e[a:b]]), np.concatenate([past_units, unit[a:b]]), whole, v, len(past_edges), left[a:b], {})
            )

    def sample(self, k: int) -> list[list[tuple[list[int], float, float]]]:
        """Per text: pieces, log probability and log inclusion score of up to ``k`` segmentations."""
        n, none = len(self.count), np.zeros(0, np.int64)
        self.paths: list[list[Path]] = [[] for _ in range(n)]
        full = np.flatnonzero(self.count)
        if len(full):
            root = -np.log(-np.log(_uniform(self.seed, np.zeros(n, np.int64), 0, 2)))
            ranges = [np.arange(self.end[d] - self.count[d], self.end[d]) for d in full]
            self._grown(
                [(d, root[d], none, none, 0.0, r, self.lattices.start[self.units[r]], np.zeros(0)) for d, r in zip(full, ranges, strict=True)], 0
            )
        for path in range(1, k):
            starts = [s for d in full if (s := self._split(int(d), path)) is not None]
            if starts:
                self._grown(starts, path)
        return [self._results(d, k) for d in range(n)]

    def _split(self, d: int, path: int) -> tuple | None:
        """Take the best subtree off the agenda, and put back what is left of it without the piece now drawn."""
        value, step, parent = max((*p.best(), i) for i, p in enumerate(self.paths[d]))
        if value == -np.inf:
            return None
        p, lat = self.paths[d][parent], self.lattices
        old = int(p.edges[step])
        place = int(np.searchsorted(lat.first, old, "right")) - 1
        options = np.arange(lat.first[place], lat.first[place + 1])
        taken = p.taken.setdefault(step, [old])
        left = np.ones(len(options), bool)
        left[np.array(taken) - options[0]] = False
        options = options[left]
        share = np.exp(lat.log_share[options])
        unit = int(p.units[step])
        spot = np.array([self.offset[unit] + place - lat.start[self.units[unit]]])
        seed = self.seed[d : d + 1]
        running = np.cumsum(share)
        pick = min(int(np.searchsorted(running, _uniform(seed, spot, path, 2)[0] * running[-1])), len(options) - 1)
        new = int(options[pick])
        taken.append(new)
        log = float(p.before[step])
        rest = share.sum() - share[pick] if len(options) > 1 else 0.0
        p.left[step - p.begin] = -np.inf
        if rest > 0:
            mass = np.array([log + np.log(rest)])
            p.left[step - p.begin] = _truncated(mass, np.array([value]), _uniform(seed, spot, path, 3))[0]
        after = np.arange(unit + 1, self.end[d])
        places = lat.start[self.units[after]]
        if not lat.ends[new]:
            after, places = np.append(unit, after), np.append(lat.target[new], places)
        return (
            d, value, np.append(p.edges[:step], new), np.append(p.units[:step], unit), log + float(lat.log_share[new]),
            after, places, p.before[: step + 1],
        )

    def _results(self, d: int, k: int) -> list[tuple[list[int], float, float]]:
        if not self.count[d]:
            return [([], 0.0, 0.0)]
        bound = max((p.best()[0] for p in self.paths[d]), default=-np.inf)
        out = []
        for p in self.paths[d]:
            log = float(p.before[-1])
            inclusion = 0.0
            if bound > -np.inf:
                ratio = log - bound
                inclusion = ratio if ratio < -30 else float(np.log(-np.expm1(-np.exp(min(ratio, 50.0)))))
            out.append((self._pieces(p.edges), log, inclusion))
        return out

    def _pieces(self, edges: np.ndarray) -> np.ndarray:
        ids = self.lattices.piece[edges]
        if (ids >= 0).all():
            return ids
        spelled = [[i] if i >= 0 else [self.vocabulary.byte_ids[b] for b in chr(-i - 1).encode()] for i in ids.tolist()]
        return np.array([i for x in spelled for i in x], np.int64)


def _groups(texts: list[str], group: int = GROUP) -> list[tuple[int, int]]:
    """Ranges of texts with at most ``group`` characters together, of about the same size, or one longer text."""
    total = sum(map(len, texts))
    even = min(group, -(-total // max(1, -(-total // group))) + 1)
    out, begin, size = [], 0, 0
    for i, t in enumerate(texts):
        if i > begin and (size + len(t) > group or size >= even):
            out.append((begin, i))
            begin, size = i, 0
        size += len(t)
    return [*out, (begin, len(texts))] if texts else []


def row_seed(key: object, seed: int) -> int:
    return xxhash.xxh64_intdigest(str(key), seed)


def encoded(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES, seed: int = 0,
    model_file: str = MODEL, checksum: bool = False, group: int = GROUP, verify: bool = False,
) -> DataFrame:
    """One row per document and sample: ``id``, ``sample`` from 1, ``pieces``, ``log_prob``, ``log_inclusion``.

    ``group`` bounds the characters worked out together, at about 150 bytes each.
    With ``checksum`` also ``text_crc32``, of the text that the pieces decode to; with ``verify`` too, and pieces
    that decode to another checksum than that of the input text raise an error.

    The vocabulary, some ten thousand pieces, is read by the driver and broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_file))
    checksum = checksum or verify
    pieces = to_arrow_type(ArrayType(IntegerType()))

    def rows(columns: list[list]) -> list[list]:
        out: list[list] = [[] for _ in range(5 + checksum)]
        texts = [t or "" for t in columns[1]]
        for a, b in _groups(texts, group):
            sampler = Sampler(texts[a:b], [row_seed(x, seed) for x in columns[0][a:b]], shared.value)
            found = sampler.sample(samples)
            flat = [np.asarray(one[0], np.int32) for x in found for one in x]
            crcs = shared.value.checksums(flat) if checksum else [None] * len(flat)
            checked = iter(zip(flat, crcs, strict=True))
            for key, text, some in zip(columns[0][a:b], texts[a:b], found, strict=True):
                want = zlib.crc32(text.encode()) if verify else None
                for i, (_, *logs) in enumerate(some):
                    one, crc = next(checked)
                    if verify and crc != want:
                        raise ValueError(f"sample {i + 1} of document {key!r} does not decode to its text")
                    for place, value in zip(out, (key, i + 1, one, *logs, *([crc] if checksum else [])), strict=True):
                        place.append(value)
        # Pieces leave as one flat array with offsets.
        ends = np.cumsum([0, *map(len, out[2])], dtype=np.int32)
        flat = np.concatenate(out[2]) if out[2] else np.zeros(0, np.int32)
        out[2] = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), type=pieces)
        return out

    schema = schema_of(
        id=docs.schema[id_col].dataType, sample="int", pieces="array<int>", log_prob="double", log_inclusion="double",
        **({"text_crc32": "long"} if checksum else {}),
    )
    return map_slices(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), rows, schema, ROWS)


def decoded(rows: DataFrame, pieces_col: str = "pieces", model_file: str = MODEL) -> DataFrame:
    """The rows with ``text`` instead of the pieces; null pieces give a null text."""
    shared = rows.sparkSession.sparkContext.broadcast(Vocabulary.load(model_file))
    others = [c for c in rows.columns if c != pieces_col]

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, DECODED):
                part = batch.slice(at, DECODED)
                # Pieces stay one flat array; a list of lists would cost more than the decoding.
                column = part.column(part.num_columns - 1)
                flat, ends = column.values.to_numpy(), column.offsets.to_pylist()
                known = column.is_valid().to_pylist()
                found = [
                    None if not ok else shared.value.decode(flat[a:b].tolist()) if b > a else ""
                    for ok, a, b in zip(known, ends[:-1], ends[1:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, pa.string())], names=[*others, "text"])

    schema = schema_of(**{c: rows.schema[c].dataType for c in others}, text="string")
    return rows.select(*others, pieces_col).mapInArrow(texts, schema)
