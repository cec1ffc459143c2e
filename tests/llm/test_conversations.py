"""Conversation repair against a search from the end, and block by block against all at once."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from kliping.llm import conversations as C

SPACE = " \t\n\v\f\r"


def cheapest(symbols):
    """Brute force: the least (cost, audit) of all edits, from the end; states by what was said last."""
    following = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @cache
    def rest(at, last, inserted):
        ways = [(0, "")] if at == len(symbols) and last in ("", "a") else []
        if inserted < 3:
            ways += [(2 + c, "I" + x) for r, s in following[last].items() if r != "s" for c, x in [rest(at, s, inserted + 1)]]
        if at < len(symbols):
            symbol, late = symbols[at].lower(), symbols[at].isupper()
            ways += [(3 + c, "D" + x) for c, x in [rest(at + 1, last, 0)]]
            if symbol != "d":
                for r, s in following[last].items():
                    if r == symbol:
                        ways += [(late + c, "K" + x) for c, x in [rest(at + 1, s, 0)]]
                    if r != "s":
                        ways += [(2 + late + c, "R" + x) for c, x in [rest(at + 1, s, 0)]]
        return min(ways, default=(10**6, ""))

    return rest(0, "", 0)


def test_decisions():
    rng = random.Random(2)
    assert C.decide("") == (0, "") and C.decide("sua") == (0, "KKK") and C.decide("s") == (3, "D")
    for n in range(400):
        symbols = "".join(rng.choices("suaxSUAXd" if n % 2 else "suad", k=rng.randint(0, 12)))
        assert C.decide(symbols) == cheapest(symbols), symbols
        cuts = sorted(rng.choices(range(len(symbols) + 1), k=3))
        parts = [p for p in (symbols[a:b] for a, b in zip([0, *cuts], [*cuts, len(symbols)], strict=True)) if p]
        if parts:
            way = C.chain(iter(C.table(p) for p in parts))
            assert "".join(a for _, _, a in way) == cheapest(symbols)[1], (symbols, parts)


def expected(rows, harm=True):
    """Brute force of the query over (conv_id, turn, role, text) rows."""
    talks = {}
    for conv, turn, role, text in rows:
        fill = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        mark = zlib.crc32(f"{fill[0]}:{fill[1]}".encode()) % 20 if harm else 9
        own = talks.setdefault(conv, [])
        role = "user" if mark == 4 else fill[2]
        text = "" if mark == 1 else re.sub("[.!?]", "", fill[3]) if mark == 2 else fill[3]
        own += [(turn, role, text)] * (0 if mark == 0 else 2 if mark == 3 else 1)
    out = {}
    for conv, own in talks.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        faults, seen = [], set()
        for _, role, text in own:
            end = text.rstrip(SPACE)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
            seen.add((role, text))
        symbols = ""
        for (_, role, _), fault in zip(own, faults, strict=True):
            first = role[:1] if role[:1] in ("s", "u", "a") else "x"
            symbols += "d" if fault in ("blank", "duplicate") else first.upper() if fault else first
        cost, audit = cheapest(symbols)
        done, at = [], iter(own)
        for letter in audit:
            _, role, text = (0, "", "") if letter == "I" else next(at)
            if letter in "IR":
                role = "assistant" if done and done[-1].startswith("user") else "user"
            if letter != "D":
                done.append(f"{role}:{text}")
        turns = [t for t, _, _ in own if t is not None]
        initials = [r[:1] for _, r, _ in own]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(done).encode()).hexdigest(),
        )
    return out


def talks():
    rng = random.Random(4)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 14)):
            if rng.random() < 0.9:
                role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", None, ""])
                text = rng.choice(["Yes.", "No!", "Why?", "and", "", " \t", None, f"Text {turn}.", "ü𝄞?", f"cut {turn}", "dots. and. ends?\n"])
                rows.append((conv, turn * rng.choice([1, 1, 2]) + 100 * turn, role, text))
    rows += [(500, None, "user", "Only."), (501, 3, "s", "x" * 50_000), (502, 7, "system", "One."), (503, 0, None, None)]
    return rows + [(504, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(120)]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(*r, "c", "b", 1) for r in talks()]
    schema = "conv_id long, turn long, role string, text string, conv string, part string, seq int"
    return spark.createDataFrame(rows, schema).repartition(5).cache()


@pytest.mark.parametrize("block", [C.BLOCK, 3, 1])
def test_repair(spark, frame, block):
    got = C.with_every_conversation(C.repaired(C.damaged(frame), block=block), frame).collect()
    want = expected(talks())
    assert {r[0]: tuple(r[1:]) for r in got} == want and len(got) == len(want)


def test_undamaged_and_empty(spark, frame):
    plain = frame.filter("conv_id >= 500")
    got = {r[0]: tuple(r[1:]) for r in C.repaired(plain).collect()}
    assert got == expected([r for r in talks() if (r[0] or 0) >= 500], harm=False)
    assert got[504][5:7] == (0, "K" * 120)
    none = frame.filter("turn < -5")
    assert C.repaired(none).count() == 0 and C.with_every_conversation(C.repaired(none), none).count() == 0
    lost = C.with_every_conversation(C.repaired(none), plain.filter("conv_id = 502")).first()
    assert tuple(lost) == (502, 0, 0, 0, 0, 0, 0, "", C.EMPTY)


def test_repeated_rows_are_duplicates(spark):
    row = [(1, 0, "user", "A."), (1, 0, "user", "A."), (1, 1, "assistant", "B."), (1, 1, "assistant", "B.")]
    got = C.repaired(spark.createDataFrame(row, "conv_id long, turn long, role string, text string")).first()
    assert (got.duplicate, got.cost, got.audit, got.gaps) == (2, 6, "KDKD", 0)


def test_one_conversation_over_many_tasks(spark):
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["A.", "b", f"{t}!", f"{t}?", ""])) for t in range(700)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = C.repaired(frame.select("*", F.lit(0).alias("block")), block=64).first()
    blank = sum(r[3] == "" for r in rows)
    first = len({(r[2], r[3]) for r in rows if r[3]})
    assert got.blank == blank and got.duplicate == 700 - blank - first
    plain = [(C._symbol(r[2], ""), r) for r in rows]
    seen, symbols = set(), ""
    for symbol, r in plain:
        symbols += "d" if not r[3] or (r[2], r[3]) in seen else symbol.upper() if r[3] == "b" else symbol
        seen.add((r[2], r[3]))
    assert (got.cost, got.audit) == C.decide(symbols)
    assert got.repaired_sha256 == hashlib.sha256("\n".join(C.applied(got.audit, [r[2:] for r in rows])).encode()).hexdigest()
