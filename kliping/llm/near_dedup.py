"""Near-duplicates by bottom-k sketches: inverted lists, union-sketch estimates, exact Jaccard.

A document's set holds the 64-bit hashes of its distinct shingles; its sketch
is the ``K`` smallest of them, one hash function for all. Equal sets are one
node. Nodes that share a retained value stand in one inverted list.

Two sets of similarity 0.8 share 0.8 of their union's sketch on average and
``ESTIMATE`` of it at least, five standard deviations below (sets that fit
into the sketch are held whole, there it is certain). So each sketch is listed
only under its rarest values, as many as leave no room for ``ESTIMATE`` of it
outside; a value of one node is the rarest of all and makes no list.

A list of many near copies is not turned into pairs. In a few rounds every list
names one member, first the one with the fewest values of its own, then others
by hash, and the members of other components are held against it: the union
sketch gives an estimate, exact sets confirm, confirmed links merge components.
Lists within one component are done with. What the rounds leave open goes an
exact way: the full sets of the nodes in open lists are listed under their
rarest shingles, the fifth that a partner of similarity 0.8 cannot miss as a
whole, and pairs of different components there are verified if what either has
from that shingle on, in order of rarity, can be enough. So links
between different texts are lost only where the estimate fails, and no list
ends up as all its pairs unless its members are candidates of as many
components.

Null or empty texts and texts without words have empty sets and no links. Null
ids never stand for a component; repeated rows are linked and share the
smallest id, so ``kept`` holds for all of them; ``one_of_each`` keeps one row of
a group, whatever repeats. Ties have no effect. Extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kliping.llm.graph import components
from kliping.llm.shared import map_slices, schema_of, stored, without

K = 64
SHINGLE = 5
PERCENT = 80
ESTIMATE = 0.55
ROUNDS = 2

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], shingle: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, one without words none."""
    split = [(t or "").encode().lower().split() for t in texts]
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for x in split for w in x), np.int64)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in numbers), np.uint64, len(numbers))
    words = hashes[ids] if len(ids) else np.zeros(0, np.uint64)
    n = len(words) - shingle + 1
    joined = np.zeros(max(0, n), np.uint64)
    for k in range(shingle):
        joined = _mixed(joined + words[k : k + len(joined)] + _MIX[0])
    out, at = [], 0
    for x in split:
        if len(x) >= shingle:
            out.append(np.unique(joined[at : at + len(x) - shingle + 1].view(np.int64)))
        elif x:
            own = np.zeros(1, np.uint64)
            for w in words[at : at + len(x)]:
                own = _mixed(own + w + _MIX[0])
            out.append(own.view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
        at += len(x)
    return out


def sketched(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, k: int = K) -> DataFrame:
    """Stored: ``row``, ``id``, ``digest`` of the text, ``n`` shingles, ``key`` of the set, ``sketch``."""

    def rows(columns: list[list]) -> list[list]:
        sets = shingle_sets(columns[2], shingle)
        return [
            columns[0], columns[1], [len(s) for s in sets],
            [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], [s[:k] for s in sets],
        ]

    schema = schema_of(id=docs.schema[id_col].dataType, digest="long", n="long", key="binary", sketch="array<long>")
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text"))
    return stored(map_slices(texts, rows, schema).withColumn("row", F.monotonically_increasing_id()), "sketches")


def _rarest(entries: DataFrame, length: Column) -> DataFrame:
    """``value`` and ``node`` under the ``length`` rarest of each node's values.

    ``entries`` hold ``value``, ``node``, ``size``. Values of one node come
    first in rarity and count, but are not listed; ``own`` is their number.
    ``size``, ``own`` and the ``place`` of the value in that order go along.
    """
    common = entries.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = entries.join(common, "value")
    by_node = shared.groupBy("node", "size").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("values"))
    own = F.col("size") - F.size("values")
    return (
        by_node.withColumn("own", own)
        .withColumn("take", length - own)
        .filter("take > 0")
        .select("node", "size", "own", F.posexplode(F.slice("values", F.lit(1), F.col("take").cast("int"))))
        .select(F.col("col.value").alias("value"), "node", "size", "own", (F.col("own") + F.col("pos")).alias("place"))
    )


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs ``a``, ``b`` those whose estimate leaves it possible and whose full sets confirm it."""
    parts = ("node", "n", "sketch", "shingles")
    left, right = (sets.select(*(F.col(c).alias(f"{c}_{side}") for c in parts)) for side in "ab")
    both = pairs.join(left, F.col("a") == F.col("node_a")).join(right, F.col("b") == F.col("node_b"))
    top = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), F.lit(1), F.least(F.size("sketch_a"), F.size("sketch_b")))
    seen = F.size(F.array_intersect(F.array_intersect(top, "sketch_a"), "sketch_b"))
    whole = F.least("n_a", "n_b") <= F.least(F.size("sketch_a"), F.size("sketch_b"))
    alike = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    same = F.size(F.array_intersect("shingles_a", "shingles_b"))
    return (
        both.filter(alike & (whole | (seen >= F.lit(ESTIMATE) * F.size(top))))
        .filter(100 * same >= percent * (F.col("n_a") + F.col("n_b") - same))
        .select("a", "b")
    )


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (``node``, ``root``) with the roots that ``links`` connect merged."""
    root = lambda side: labels.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
    joined = links.join(root("a"), "a").join(root("b"), "b")
    merged = components(stored(joined.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")), "links"))
    to = merged.select(F.col("node").alias("root"), F.col("root").alias("to"))
    return stored(labels.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "labels")


def _open_lists(lists: DataFrame, labels: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Entries with their roots, and the lists of several roots with the member each names in this turn."""
    entries = lists.join(labels, "node")
    order = F.struct("own", "node") if turn == 0 else F.struct(F.xxhash64("node", F.lit(turn)), "node")
    heads = entries.groupBy("value").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.min(F.struct(order, "node", "root")).alias("head")
    )
    heads = heads.filter("low < high")
    return entries, heads.select("value", F.col("head.node").alias("hub"), F.col("head.root").alias("hub_root"))


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _rest(lists: DataFrame, labels: DataFrame, sets: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """Links between components that still share a list, by the rarest shingles of the full sets."""
    entries, heads = _open_lists(lists, labels, 0)
    open_nodes = entries.join(heads, "value").select("node", "root").distinct()
    full = stored(open_nodes.join(sets, "node").select("node", "root", "n", "shingles"), "open-sets")
    entries = full.select("node", F.col("n").alias("size"), F.explode("shingles").alias("value"))
    # A partner has at least percent / 100 of the set in common, so it has one of the others and one more.
    length = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1
    rare = stored(_rarest(entries, length).join(full.select("node", "root"), "node"), "rare-shingles")
    spread = rare.groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    parts = ["value", "node", "root", "size", "place"]
    rare = rare.join(spread.select("value"), "value").select(*parts)
    other = rare.select(*(F.col(c).alias(f"{c}_b") for c in parts))
    # In the common order of rarity, nothing before the first common value is common.
    room = F.least(F.col("size") - F.col("place"), F.col("size_b") - F.col("place_b"))
    pairs = rare.join(
        other,
        (F.col("value") == F.col("value_b"))
        & (F.col("root") < F.col("root_b"))
        & ((100 + percent) * room >= percent * (F.col("size") + F.col("size_b"))),
    )
    pairs = pairs.select(*_ordered("node", "node_b")).distinct().join(tried, ["a", "b"], "left_anti")
    return _linked(pairs, sets, percent)


def _members(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """One row per document: ``row``, ``id``, ``digest`` of the text, ``n`` shingles, ``group``."""
    rows = sketched(docs, id_col, text_col, shingle)
    nodes = rows.filter("n > 0").groupBy("key").agg(F.min("row").alias("node"))
    own = rows.join(nodes, "key").filter("row = node").select("node", "id", "digest", "n", "sketch")
    own = stored(own, "node-sketches")
    spelled = own.select("node", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    length = F.col("size") - F.ceil(F.col("size") * ESTIMATE) + 1
    lists = stored(_rarest(spelled, length), "inverted-lists")
    sets = _full_sets(docs, own.join(lists.select("node").distinct(), "node"), id_col, text_col, shingle)
    labels = lists.select("node", F.col("node").alias("root")).distinct()
    tried = None
    for turn in range(ROUNDS):
        entries, heads = _open_lists(lists, labels, turn)
        pairs = entries.join(heads, "value").filter("root <> hub_root").select(*_ordered("node", "hub")).distinct()
        pairs = stored(pairs, "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        labels = _relabelled(labels, _linked(pairs, sets, percent))
    labels = _relabelled(labels, _rest(lists, labels, sets, tried, percent))
    members = rows.select("row", "id", "digest", "n", "key").join(nodes, "key", "left").join(labels, "node", "left")
    return members.select("row", "id", "digest", "n", F.coalesce("root", "node", "row").alias("group"))


def grouped(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row per document: ``id``, ``digest`` of the text, ``n_shingles``, ``component_id``, ``kept``."""
    members = _members(docs, id_col, text_col, shingle, percent)
    least = members.groupBy("group").agg(F.min("id").alias("component_id"))
    return members.join(least, "group").select(
        "id", "digest", F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Stored: ``node``, ``n``, ``sketch`` and all ``shingles`` of the wanted nodes, from their texts again."""
    keys = wanted.select("node", F.col("id").alias("own_id"), F.col("digest").alias("own_digest"), "n", "sketch")
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text"))
    same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("digest") == F.col("own_digest"))
    found = texts.join(keys, same).select("node", "n", "sketch", "text")

    def rows(columns: list[list]) -> list[list]:
        return [*columns[:3], shingle_sets(columns[3], shingle)]

    schema: StructType = schema_of(node="long", n="long", sketch="array<long>", shingles="array<long>")
    # A repeated row with the node's id and text has the same set.
    return stored(map_slices(found, rows, schema).dropDuplicates(["node"]), "full-sets")


def representatives(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """The documents, same columns, of each group those with the smallest id: repeated rows of it all stay."""
    gone = grouped(docs, id_col, text_col, shingle, percent).filter(~F.col("kept"))
    return without(docs, gone, id_col, text_col)


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """The documents, same columns, exactly one row of each group: of those with the smallest id, null only if all are.

    Texts without words have no links, so each of their rows stays.
    """
    members = _members(docs, id_col, text_col, shingle, percent)
    members = stored(members.select("row", "id", "digest", "group"), "members")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row", "digest")
    best = members.groupBy("group").agg(F.min(order).alias("best"))
    same = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("digest") == F.col("best.digest"))
    others = members.join(best, "group").filter(F.col("row") != F.col("best.row"))
    # With ``again``, rows that repeat the one that stays; all rows of these go, but for one that comes back below.
    others = stored(others.select("id", "digest", same.alias("again")).distinct(), "other-members")
    left = without(docs, others, id_col, text_col)
    again = others.filter("again").select(F.col("id").alias("_again_id"), F.col("digest").alias("_again_digest"))
    if again.isEmpty():
        return left
    repeated = docs[id_col].eqNullSafe(F.col("_again_id")) & (F.xxhash64(docs[text_col]) == F.col("_again_digest"))
    back = docs.join(again, repeated, "left_semi").withColumn("_again_digest", F.xxhash64(text_col))
    return left.unionByName(back.dropDuplicates([id_col, "_again_digest"]).drop("_again_digest"))
