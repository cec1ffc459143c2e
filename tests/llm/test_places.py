"""Sharding, WARC archives and segmentation: permutations, exact round trips, brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kliping.llm import segmentation, sharding, warc
from kliping.llm.shared import new_path

from .conftest import as_set


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000])
def test_permutation(spark, n):
    to = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n, 3)).collect()]
    assert sorted(to) == list(range(n))
    assert n < 16 or to != list(range(n))


def test_shards(docs, none, rows):
    got = sharding.shuffled(docs, shards=7, seed=1)
    out = got.collect()
    assert sorted(r.row_number for r in out) == list(range(len(rows)))
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    want = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows]
    assert as_set(got, "id", "size", "crc") == sorted(want, key=repr)
    order = [(r.id is not None, r.id or 0) for r in sorted(out, key=lambda r: r.row_number)]
    assert order == sorted(order)
    again = sharding.shuffled(docs.repartition(3), shards=7, seed=1)
    assert as_set(again, "id", "crc", "copy", "shard", "slot") == as_set(got, "id", "crc", "copy", "shard", "slot")
    assert sharding.shuffled(none).count() == 0


@pytest.mark.parametrize("range_bytes", [57, 4000, 1 << 23])
def test_archive_round_trip(spark, docs, none, rows, range_bytes):
    path = new_path(spark, "archive")
    warc.write_archive(docs, path, "doc_id", "text", None)
    got = warc.read_archive(spark, path, range_bytes)
    groups = {}
    for i, t, _ in rows:
        d = (t or "").encode()
        if i is not None and len(d) >= 100:
            groups[d] = min(groups.get(d, i), i)
    want = []
    for i, t, _ in rows:
        d = (t or "").encode()
        refers = groups.get(d) if len(d) >= 100 and Counter(r[1] for r in rows)[t] > 1 else None
        refers = None if refers == i else refers
        kind = "response" if refers is None else "revisit"
        want.append((i, kind, refers, hashlib.sha256(d).hexdigest(), len(d), d if kind == "response" else None))
    key = lambda r: repr((r[0], r[1], r[3]))
    found = [(r.id, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes, None if r.payload is None else bytes(r.payload)) for r in got.collect()]
    assert sorted(found, key=key) == sorted(want, key=key)
    if range_bytes > 4000:
        path = new_path(spark, "archive")
        warc.write_archive(none, path, "doc_id", "text", None)
        assert warc.read_archive(spark, path).count() == 0


def test_records_behind_false_magic():
    one = warc.record(1, "http://a/ b\n", b"payload", "d", None)
    big = bytes(range(256)) * (1 << 16)  # 16 MiB: its length field ends otherwise than with zero
    members = [warc.gzip_member(x) + b"\x00" for x in (one, one + big, one)]
    assert all(zlib.decompressobj(31).decompress(m) == x for m, x in zip(members, (one, one + big, one), strict=True))
    data = warc.MAGIC + b"junk" + members[0] + warc.MAGIC + members[1] + members[2]
    for cut in (0, 1, 9, 40, len(members[0]) + 7, len(data) - 30, len(data)):
        file = pa.BufferReader(data)
        found = [*warc.members_in(file, 0, cut), *warc.members_in(file, cut, len(data))]
        assert list(map(len, found)) == [len(one), len(one) + len(big), len(one)]
    assert warc.parsed(one)[:4] == ("1", "http://a/%20b%0A", "response", None)


@pytest.fixture(scope="module")
def vocabulary():
    return segmentation.Vocabulary.load()


def _all(text, v):
    """Every segmentation of the text and its log probability."""
    weights = {v.pieces[i]: (int(i), v.weight[s]) for s, i in enumerate(v.piece) if i >= 0}
    spelled, out = (" " + text).replace(" ", segmentation.MARK), {}

    def go(at, ids, weight):
        if at == len(spelled):
            out[tuple(ids)] = weight
        for end in range(at + 1, len(spelled) + 1):
            if spelled[at:end] in weights:
                i, w = weights[spelled[at:end]]
                go(end, [*ids, i], weight + w)
        if at < len(spelled) and spelled[at] not in weights:
            raw = spelled[at].encode()
            go(at + 1, [*ids, *(v.byte_ids[b] for b in raw)], weight + len(raw) * v.byte_weight)

    go(0, [], 0.0)
    total = np.logaddexp.reduce(list(out.values()))
    return {k: w - total for k, w in out.items()}


@pytest.mark.parametrize("text", ["the at", "hello", "of\nﬁ a", "x"])
def test_samples_follow_the_lattice(vocabulary, text):
    every, n = _all(text, vocabulary), 6000
    found = segmentation.Sampler([text] * n, [segmentation.row_seed(i, 1) for i in range(n)], vocabulary).sample(2)
    assert all(abs(p - every[tuple(map(int, ids))]) < 1e-9 for x in found for ids, p, _ in x)
    assert all(len({tuple(ids) for ids, _, _ in x}) == min(2, len(every)) for x in found)
    p = {k: math.exp(v) for k, v in every.items()}
    for place, want in enumerate([p, {b: sum(p[a] * p[b] / (1 - p[a]) for a in p if a != b) for b in p}]):
        counts = Counter(tuple(map(int, x[place][0])) for x in found if len(x) > place)
        assert all(abs(counts[k] / n - want[k]) < 5 * math.sqrt(0.25 / n) for k in want)
    # Weighing by inclusion makes up for what was left out.
    assert abs(np.mean([sum(math.exp(q - i) for _, q, i in x) for x in found]) - 1) < 0.05


def test_all_segmentations_come_out(vocabulary):
    every = _all("heat", vocabulary)
    (found,) = segmentation.Sampler(["heat"], [5], vocabulary).sample(len(every) + 3)
    assert {tuple(map(int, ids)) for ids, _, _ in found} == set(every) and {i for _, _, i in found} == {0.0}


def test_units_and_checksums_in_bulk(vocabulary):
    """Units of whole groups against a pattern, and checksums of whole groups against texts decoded one by one."""
    rng = random.Random(9)
    parts = [" ", "  ", "\n", "\n\n", "a", "the", "ü€", "𝄞", "\x00", "\t", "\u2028", "\xa0", segmentation.MARK, "ab cd"]
    texts = ["", "", " ", "\n", "a", *("".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(400)), "", ""]
    units, count = segmentation._units(texts)
    want = [re.findall(r"\n| *[^ \n]+| +", " " + t) if t else [] for t in texts]
    assert units.to_pylist() == [u for x in want for u in x] and count.tolist() == list(map(len, want))
    assert units.dictionary.to_pylist() == list(dict.fromkeys(units.to_pylist()))
    for some in ([], ["", ""], texts):
        units, count = segmentation._units(some)
        assert len(units) == count.sum() and len(count) == len(some)
        found = segmentation.Sampler(some, list(range(len(some))), vocabulary).sample(2)
        pieces = [np.asarray(ids, np.int32) for x in found for ids, _, _ in x]
        assert vocabulary.checksums(pieces) == [zlib.crc32(t.encode()) for t, x in zip(some, found, strict=True) for _ in x]
        assert vocabulary.checksums(pieces) == [zlib.crc32(vocabulary.decode_bytes(ids.tolist())) for ids in pieces]


def test_draws_reach_the_edge_of_their_share(vocabulary):
    """The first edge of a place whose summed share reaches the number drawn, and its last for numbers next to 1."""
    units, _ = segmentation._units(["the heat of the ﬁre", "at\n  x"])
    lattices = segmentation.Lattices(units.dictionary, vocabulary)
    for place in range(len(lattices.first) - 1):
        a, b = int(lattices.first[place]), int(lattices.first[place + 1])
        share = np.cumsum(np.exp(lattices.log_share[a:b]))
        assert abs(share[-1] - 1) < 1e-9
        for u in (2.0**-54, 0.25, 0.5, 0.75, 1 - 2.0**-53, 1 - 2.0**-54):
            near = np.abs(share - u).min() < 1e-9
            got = int(lattices.drawn(np.array([place]), np.array([u]))[0])
            assert near or got == a + min(int(np.searchsorted(share, u)), b - a - 1)


def test_encoding_round_trip(docs, none, rows, vocabulary):
    got = segmentation.encoded(docs, samples=3)
    texts = segmentation.decoded(got).select("id", "sample", "text").collect()
    first = sorted(((r.id, r.text) for r in texts if r.sample == 1), key=repr)
    assert first == sorted(((i, t or "") for i, t, _ in rows), key=repr)
    assert {(r.id, r.text) for r in texts} == {(i, t or "") for i, t, _ in rows}
    again = segmentation.encoded(docs.repartition(2), samples=3)
    assert as_set(again, "id", "sample", "pieces") == as_set(got, "id", "sample", "pieces")
    assert segmentation.encoded(none).count() == 0
    odd = f"a{segmentation.MARK}b  c {segmentation.MARK}"
    assert vocabulary.decode([int(i) for i in segmentation.Sampler([odd], [1], vocabulary).sample(1)[0][0][0]]) == odd
