"""Conversation structure repair by generalised LR parsing with weighted edits.

The role grammar is ``Talk -> e | Turns | s Turns``, ``Turns -> Pair | Turns Pair``,
``Pair -> u a``. A pair is reduced as soon as its assistant turn is shifted, so a
parse stack is known by its top: START, SYSTEM, USER or TURNS, and what may follow
depends on the top alone. The parser carries all stacks at once as one
graph-structured stack. Every row may be kept (0), given the role the parser waits
for (2) or deleted (3), and empty turns may be inserted (2) anywhere; blank and
repeated rows must go, and a row with a cut-off end costs 1 more unless it goes.
Stacks with equal tops are merged by the minimum of (cost, audit); the audit is the
string of the edits' initials K, R, D, I. That loses nothing: two audits of equal
cost over the same rows are never each other's beginning (the longer one would hold
more inserts), so the smaller stays smaller whatever follows. A conversation
whose rows can all be kept has a single stack and needs no search.

Rows are range partitioned by conversation and turn, so a conversation that holds a
third of all rows is spread over many tasks. Conversations that lie within one task
and have fewer than ``BLOCK`` rows and ``BLOCK_BYTES`` of text are repaired where they
are. The others (the long ones, and those at the ends of a task) are cut into blocks:
each block is parsed from all four tops at once, the small tables (top to top:
cost, audit) are chained per conversation, and each block is then repaired with the
edits found. Chaining compares audits without keeping them: once two differ, their
order is settled. Only the checksum of a conversation needs its blocks in order; one
task streams their finished texts through it, one block in memory at a time.

Rows are taken by turn, null turns first; equal turns by role, then by a hash of the text. Null roles
and texts are one space; rows without a conversation id are one conversation. A role
counts by its first character; an empty one has none and is never kept as it is.
Repeated rows are duplicates. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from kliping.llm.shared import map_slices, schema_of, stored

BLOCK = 1024
BLOCK_BYTES = 1 << 20
SPACE = " \t\n\x0b\x0c\r"

KEEP, REROLE, DELETE, INSERT = (0, "K"), (2, "R"), (3, "D"), (2, "I")
START, SYSTEM, USER, TURNS = range(4)
# The top after shifting a role; ``u a`` is reduced at once.
SHIFT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": TURNS}, {"u": USER})
ACCEPT = (START, TURNS)
EMPTY = hashlib.sha256(b"").hexdigest()

Tops = dict[int, tuple[int, str]]


def _offer(tops: Tops, top: int, cost: int, audit: str) -> bool:
    held = tops.get(top)
    if held is None or (cost, audit) < held:
        tops[top] = cost, audit
        return True
    return False


def _inserted(tops: Tops) -> Tops:
    """The tops and those that inserted turns lead to."""
    cost, letter = INSERT
    grown = True
    while grown:
        grown = False
        for top, (spent, audit) in list(tops.items()):
            for role in "ua":
                if role in SHIFT[top]:
                    grown |= _offer(tops, SHIFT[top][role], spent + cost, audit + letter)
    return tops


def _advance(tops: Tops, symbols: str) -> Tops:
    """All stacks over some rows, one character each: the role's, in upper case if cut off, or ``d`` if it must go."""
    for symbol in symbols:
        role, late = symbol.lower(), int(symbol.isupper())
        after: Tops = {}
        for top, (cost, audit) in tops.items():
            _offer(after, top, cost + DELETE[0], audit + DELETE[1])
            if symbol == "d":
                continue
            if role in SHIFT[top]:
                _offer(after, SHIFT[top][role], cost + KEEP[0] + late, audit + KEEP[1])
            for other in "ua":
                if other in SHIFT[top]:
                    _offer(after, SHIFT[top][other], cost + REROLE[0] + late, audit + REROLE[1])
        tops = _inserted(after)
    return tops


@lru_cache(10_000)
def decide(symbols: str) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of a whole conversation."""
    top = START
    for symbol in symbols:  # one stack, as long as every row can be kept
        top = SHIFT[top].get(symbol.lower(), -1) if symbol != "d" else -1
        if top < 0:
            break
    if top in ACCEPT:
        return sum(map(str.isupper, symbols)), KEEP[1] * len(symbols)
    tops = _advance(_inserted({START: (0, "")}), symbols)
    return min(tops[top] for top in ACCEPT if top in tops)


def table(symbols: str) -> list[tuple[int, int, int, str]]:
    """From top, to top, cost and audit of a block."""
    return [(a, b, *x) for a in range(len(SHIFT)) for b, x in _advance({a: (0, "")}, symbols).items()]


def chain(tables: Iterator[list[tuple[int, int, int, str]]]) -> list[tuple[int, int, str]]:
    """Top before, cost and audit of every block along the cheapest way through all."""
    begin = _inserted({START: (0, "")})
    # A way: cost, blocks so far as a linked list. ``rest[a, b]``: 1 or -1 if b's audit is settled to be above or below
    # a's, else what is left of the longer one, a's (0, "..") or b's (2, "..").
    ways: dict[int, tuple[int, tuple | None]] = {top: (cost, None) for top, (cost, _) in begin.items()}
    lead = {top: audit for top, (_, audit) in begin.items()}
    rest = {(a, b): _compared((0, ""), lead[a], lead[b]) for a in lead for b in lead}
    for block in tables:
        best: dict[int, tuple[int, int, str]] = {}
        for a, b, cost, audit in block:
            if a not in ways:
                continue
            total, held = ways[a][0] + cost, best.get(b)
            if held is None or total < held[0] or (total == held[0] and _compared(rest[a, held[1]], audit, held[2])[0] == 1):
                best[b] = total, a, audit
        rest = {
            (p, q): _compared(rest[best[p][1], best[q][1]], best[p][2], best[q][2]) for p in best for q in best
        }
        ways = {top: (cost, (ways[a][1], a, audit)) for top, (cost, a, audit) in best.items()}
    end = None
    for top in ACCEPT:
        if top in ways and (end is None or ways[top][0] < ways[end][0] or (ways[top][0] == ways[end][0] and rest[top, end][0] == 1)):
            end = top
    out, link = [], ways[end][1]
    while link is not None:
        link, top, audit = link
        out.append((top, 0, audit))
    out.reverse()
    if out:  # inserts before the first row belong to the first block
        first = out[0]
        out[0] = (START, 0, lead[first[0]] + first[2])
    return out


def _compared(rest: tuple[int, str], a: str, b: str) -> tuple[int, str]:
    """How two audits stand to each other once ``a`` and ``b`` follow."""
    if rest[0] in (1, -1):
        return rest
    a, b = (rest[1] + a, b) if rest[0] == 0 else (a, rest[1] + b)
    if a.startswith(b):
        return 0, a[len(b) :]
    if b.startswith(a):
        return 2, b[len(a) :]
    return (1, "") if a < b else (-1, "")


def applied(audit: str, rows: list[tuple[str, str]], top: int = START) -> list[str]:
    """The repaired turns as ``role:text``."""
    out, at = [], iter(rows)
    for letter in audit:
        wanted = "a" if top == USER else "u"
        role, text = ("", "") if letter == "I" else next(at)
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if wanted == "a" else "user"
        top = SHIFT[top][role[0]]
        out.append(f"{role}:{text}")
    return out


RESULT = {
    "gaps": "long", "blank": "long", "duplicate": "long", "truncated": "long", "illegal": "long", "cost": "long",
    "audit": "string", "repaired_sha256": "string",
}


def _symbol(role: str, fault: str) -> str:
    if fault in ("blank", "duplicate"):
        return "d"
    first = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return first.upper() if fault == "truncated" else first


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials[:-1], initials[1:], strict=True))


def _gaps(turns: list[int]) -> int:
    return turns[-1] - turns[0] + 1 - len(set(turns)) if turns else 0


def _repair(rows: list[tuple]) -> list:
    """Result columns of a whole conversation of (turn, role, text, fault) rows in order."""
    seen, faults = set(), []
    for _, role, text, fault in rows:
        if fault != "blank" and (role, text) in seen:
            fault = "duplicate"
        seen.add((role, text))
        faults.append(fault)
    cost, audit = decide("".join(_symbol(r[1], f) for r, f in zip(rows, faults, strict=True)))
    done = "\n".join(applied(audit, [(r[1], r[2]) for r in rows]))
    return [
        _gaps([r[0] for r in rows if r[0] is not None]), faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
        _illegal([r[1][:1] for r in rows]), cost, audit, hashlib.sha256(done.encode()).hexdigest(),
    ]


def _local(schema: StructType, block: int):
    """Repairs conversations inside a task; rows of the others are handed on with their place."""
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ready = TaskContext.get().partitionId(), []
        conv, rows, size, start, number, first, handed = None, [], 0, 0, 0, True, False

        def hand_on() -> None:
            ready.extend([conv, *[None] * len(RESULT), part, start, start + k, *row] for k, row in enumerate(rows))

        def send() -> pa.RecordBatch:
            columns = list(zip(*ready, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out)

        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number and key != conv:
                    if first or handed:
                        hand_on()
                    else:
                        ready.append([conv, *_repair(rows), *[None] * 7])
                    first = handed = False
                    rows, size, start = [], 0, number
                conv = key
                number += 1
                rows.append(tuple(row))
                size += len(row[2])
                if len(rows) >= block or size > BLOCK_BYTES:
                    hand_on()
                    rows, size, start, handed = [], 0, number, True
                    yield send()
                    ready.clear()
            if ready:
                yield send()
                ready.clear()
        hand_on()
        if ready:
            yield send()

    return run


def _same(a: DataFrame, b: DataFrame, names: list[str], how: str) -> DataFrame:
    """Null-safe join on ``names``; the left side's columns stay."""
    right = b.select(*[F.col(c).alias(f"_{c}" if c in names else c) for c in b.columns])
    on = [a[c].eqNullSafe(right[f"_{c}"]) for c in names]
    return a.join(right, on, how).drop(*[f"_{c}" for c in names])


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Results of conversations whose rows (with ``part``, ``block``, ``seq``) lie in several places or are many."""
    conv = rows.schema["conv"].dataType
    place = ["conv", "part", "block"]
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    keyed = rows.withColumn("digest", F.sha2(said.cast("binary"), 256))
    first = keyed.groupBy("conv", "digest").agg(F.min(F.struct("part", "seq")).alias("first"), F.count(F.lit(1)).alias("n"))
    keyed = _same(keyed, first.filter("n > 1").drop("n"), ["conv", "digest"], "left")
    again = (F.col("fault") != "blank") & F.coalesce(F.col("first") < F.struct("part", "seq"), F.lit(False))
    keyed = keyed.withColumn("fault", F.when(again, "duplicate").otherwise(F.col("fault")))
    inside = F.array_sort(F.collect_list(F.struct("seq", "turn", "role", "text", "fault")))
    blocks = stored(keyed.groupBy(*place).agg(inside.alias("rows")), "conversation-blocks")

    def tables(columns: list[list]) -> list[list]:
        *keys, found = columns
        return [*keys, [[dict(zip("abcd", x, strict=True)) for x in table("".join(_symbol(r["role"], r["fault"]) for r in rows))] for rows in found]]

    schema = schema_of(conv=conv, part="int", block="long", ways="array<struct<a:int,b:int,c:int,d:string>>")
    light = blocks.select(*place, F.transform("rows", lambda r: F.struct(F.substring(r["role"], 1, 1).alias("role"), r["fault"].alias("fault"))).alias("rows"))
    ways = map_slices(light, tables, schema, size=64)
    edits = _per_conversation(ways, _chained, schema_of(conv=conv, part="int", block="long", top="int", audit="string"))
    both = _same(blocks, edits, place, "inner").select(*place, "top", "audit", "rows")

    def repair(columns: list[list]) -> list[list]:
        out: list[list] = [[] for _ in BLOCK_RESULT]
        for *key, top, audit, rows in zip(*columns, strict=True):
            faults, symbols = [r["fault"] for r in rows], (_symbol(r["role"], r["fault"]) for r in rows)
            done = applied(audit, [(r["role"], r["text"]) for r in rows], top)
            turns = [r["turn"] for r in rows if r["turn"] is not None]
            late = sum(s.isupper() for s, a in zip(symbols, audit.replace("I", ""), strict=True) if a != "D")
            cost = late + sum(e[0] * audit.count(e[1]) for e in (REROLE, DELETE, INSERT))
            initials = [r["role"][:1] for r in rows]
            row = [
                *key, [faults.count(f) for f in ("blank", "duplicate", "truncated")], _illegal(initials), cost, audit,
                "\n".join(done) if done else None, initials[0], initials[-1], turns[:1] + turns[-1:], len(set(turns)),
            ]
            for column, value in zip(out, row, strict=True):
                column.append(value)
        return out

    parts = map_slices(both, repair, schema_of(**(BLOCK_RESULT | {"conv": conv})), size=4)
    return _per_conversation(stored(parts, "repaired-blocks"), _summed, schema_of(**({"conv": conv} | RESULT)))


BLOCK_RESULT = {
    "conv": "string", "part": "int", "block": "long", "faults": "array<long>", "illegal": "long", "cost": "long", "audit": "string",
    "done": "string", "first": "string", "last": "string", "turns": "array<long>", "distinct": "long",
}


def _per_conversation(blocks: DataFrame, fn, schema: StructType) -> DataFrame:
    """``fn`` over the blocks of each conversation in order, as a stream."""
    ordered = blocks.repartition("conv").sortWithinPartitions("conv", "part", "block")
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead = (batch.slice(k, 1).to_pylist()[0] for batch in batches for k in range(batch.num_rows))
        row = next(ahead, None)
        while row is not None:
            conv = row["conv"]

            def own(conv: object = conv) -> Iterator[dict]:
                nonlocal row
                while row is not None and row["conv"] == conv:
                    yield row
                    row = next(ahead, None)

            done = fn(conv, own())
            for k in range(0, len(done), 1000):
                columns = zip(*done[k : k + 1000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out)

    return ordered.mapInArrow(run, schema)


def _chained(conv: object, blocks: Iterator[dict]) -> list[list]:
    places: list[tuple] = []

    def tables() -> Iterator[list]:
        for x in blocks:
            places.append((x["part"], x["block"]))
            yield [(w["a"], w["b"], w["c"], w["d"]) for w in x["ways"]]

    way = chain(tables())
    return [[conv, *p, top, audit] for p, (top, _, audit) in zip(places, way, strict=True)]


def _summed(conv: object, blocks: Iterator[dict]) -> list[list]:
    faults, illegal, cost, audits, sha, distinct = [0, 0, 0], 0, 0, [], hashlib.sha256(), 0
    last, turns, any_done = None, [], False
    for x in blocks:
        faults = [a + b for a, b in zip(faults, x["faults"], strict=True)]
        illegal += x["illegal"] + (last is not None and last + x["first"] not in ("su", "ua", "au"))
        last = x["last"]
        cost += x["cost"]
        audits.append(x["audit"])
        if x["done"] is not None:
            sha.update(("\n" * any_done + x["done"]).encode())
            any_done = True
        if x["turns"]:
            distinct += x["distinct"] - (bool(turns) and turns[-1] == x["turns"][0])
            turns = (turns or x["turns"])[:1] + x["turns"][-1:]
    gaps = turns[-1] - turns[0] + 1 - distinct if turns else 0
    return [[conv, gaps, *faults, illegal, cost, "".join(audits), sha.hexdigest()]]


def repaired(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block: int = BLOCK
) -> DataFrame:
    """One row per conversation: ``conv`` and the columns of ``RESULT``."""
    text = F.coalesce(F.col(text_col), F.lit(" "))
    end = F.rtrim("text", F.lit(SPACE))
    fault = F.when(end == "", "blank").when(~F.right(end, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")
    narrow = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), text.alias("text"),
    ).withColumn("fault", fault)
    # Identical rows are spread too; their order among each other does not matter.
    spread = narrow.withColumn("_id", F.monotonically_increasing_id()).withColumn("_hash", F.xxhash64("text"))
    ordered = spread.repartitionByRange("conv", "turn", "role", "_hash", "_id").sortWithinPartitions("conv", "turn", "role", "_hash", "text")
    conv = rows.schema[conv_col].dataType
    schema = schema_of(
        conv=conv, **RESULT, part="int", block="long", seq="long", turn="long", role="string", text="string", fault="string"
    )
    mixed = stored(ordered.select("conv", "turn", "role", "text", "fault").mapInArrow(_local(schema, block), schema), "conversations")
    names = ["conv", *RESULT]
    here = mixed.filter("audit is not null").select(*names)
    others = mixed.filter("audit is null").select("conv", "part", "block", "seq", "turn", "role", "text", "fault")
    return here.unionByName(_in_blocks(others).select(*names))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults put in by the checksum of conversation and turn: dropped, emptied, cut off, repeated or given a wrong role."""
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    mark: Column = F.crc32(F.concat(filled["conv_id"], F.lit(":"), filled["turn"]).cast("binary")) % 20
    text = F.when(mark == 1, "").when(mark == 2, F.regexp_replace(filled["text"], "[.!?]", "")).otherwise(filled["text"])
    role = F.when(mark == 4, "user").otherwise(filled["role"])
    copies = F.when(mark == 0, 0).when(mark == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies)).alias("_")).drop("_")


def with_every_conversation(results: DataFrame, rows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """The results, and zeros for conversations without rows."""
    ids = rows.select(F.col(conv_col).alias("conv")).distinct()
    both = _same(ids, results, ["conv"], "left")
    defaults = {"audit": F.lit(""), "repaired_sha256": F.lit(EMPTY)}
    return both.select("conv", *[F.coalesce(c, defaults.get(c, F.lit(0).cast("long"))).alias(c) for c in RESULT])
