"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered 0 .. n-1 in the order of id, size and text digest. A Feistel
network over the smallest near-square grid that holds n numbers, walked along
its cycle until the value is below n, permutes the numbers; the value modulo
the shard count is the shard and the quotient the slot. So the law is ``rows``:
counts differ by one at most, slots have no gaps, and shard and slot of a row
number can be computed without the table (``place``).

Null ids come first, null texts count as empty for size and checksum. Repeated
rows take neighbouring numbers, one each. An empty table gives an empty result.
Only narrow rows are shuffled, and copies are told apart by their number within
the group, so one repeated row cannot fill a task.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kliping.llm.shared import stored

ROUNDS = 3  # each turns both halves
WALK = 64  # steps of the cycle walk after which a row still outside raises an error
INDEX_BITS = 33  # of monotonically_increasing_id


def _feistel(x: Column, left: int, right: int, seed: int) -> Column:
    """A permutation of 0 .. left * right - 1: modular additions to the halves in turn."""

    def turn(state: Column, i: Column) -> Column:
        l = F.pmod(state["l"] + F.pmod(F.xxhash64(state["r"], i, F.lit(seed)), F.lit(left)), F.lit(left))
        r = F.pmod(state["r"] + F.pmod(F.xxhash64(l, i, F.lit(-seed - 1)), F.lit(right)), F.lit(right))
        return F.struct(l.cast("long").alias("l"), r.cast("long").alias("r"))

    halves = F.struct(F.floor(x / F.lit(right)).cast("long").alias("l"), F.pmod(x, F.lit(right)).cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), halves, turn, lambda s: s["l"] * F.lit(right) + s["r"])


def permuted(number: Column, rows: int, seed: int) -> Column:
    """The place of a row number after the shuffle, both from 0 to ``rows`` - 1."""
    left = isqrt(max(rows - 1, 0)) + 1
    right = max(1, -(-rows // left))

    def once(x: Column) -> Column:
        return _feistel(x, left, right, seed)

    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)), once(number), lambda x, _: F.when(x >= F.lit(rows), once(x)).otherwise(x)
    )
    return F.when(walked < F.lit(rows), walked).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long"))


def place(number: Column, rows: int, shards: int, seed: int) -> tuple[Column, Column]:
    """Shard and slot of a global row number."""
    to = permuted(number, rows, seed)
    return F.pmod(to, F.lit(shards)).cast("int"), F.floor(to / F.lit(shards)).cast("long")


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``size``, ``crc``, ``digest``, ``copy`` and the global ``row_number`` of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.xxhash64(text_col).alias("digest"),
    )
    keys = ["id", "size", "crc", "digest"]
    copies = narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    rows = copies.select(*keys, F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy"))
    order = [*keys, "copy"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = stored(ordered.withColumn("at", F.monotonically_increasing_id()), "row-numbers")
    part = F.shiftright("at", INDEX_BITS)
    counts = [tuple(r) for r in kept.groupBy(part.alias("part")).count().orderBy("part").collect()]  # one row a partition
    offsets, total = [], 0
    for p, n in counts:
        offsets.append((p, total))
        total += n
    before = docs.sparkSession.createDataFrame(offsets, "part long, offset long")
    index = F.col("at").bitwiseAND(F.lit((1 << INDEX_BITS) - 1))
    return (
        kept.withColumn("part", part)
        .join(F.broadcast(before), "part")
        .select(*order, (F.col("offset") + index).alias("row_number"), F.lit(total).cast("long").alias("rows"))
    )


def shuffled(
    docs: DataFrame, shards: int = 24, seed: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id``, ``size``, ``crc``, ``digest``, ``copy``, ``row_number``, ``shard`` and ``slot`` of every row."""
    rows = numbered(docs, id_col, text_col)
    total = rows.select("rows").limit(1).collect()  # one number
    shard, slot = place(F.col("row_number"), total[0][0] if total else 0, shards, seed)
    return rows.select("*", shard.alias("shard"), slot.alias("slot")).drop("rows")
