"""Which links and rows are new.

A single key may hold a large share of all rows. The jobs below therefore
shrink copies on the map side first (partial aggregates, or a row number limit
that Spark applies before its shuffle) and join what is left on keys that are
unique; row-level joins on a hot key are left to adaptive skew splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kliping.session import durable

GRAMS = (8, 3)  # characters of the grams that wildcard patterns are joined by
PER_BLOCK = 10_000  # stored values of a gram that are compared in one block


def url_counts(rows: DataFrame, key: str = "url_key") -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def new_links(links: DataFrame, store: DataFrame, key: str = "url_key", mode: str = "equal") -> DataFrame:
    """Links whose key the store does not hold.

    ``mode='like'`` reads each incoming key as a LIKE pattern, so ``_`` and ``%``
    in it are wildcards.
    """
    if mode == "equal":
        return links.join(store.select(key), key, "left_anti")
    if mode != "like":
        raise ValueError(f"unknown mode {mode!r}")
    return _unmatched_patterns(links, store.select(F.col(key).alias("stored")), key)


def seen_links(links: DataFrame, store: DataFrame, key: str = "url_key") -> DataFrame:
    return links.join(store.select(key), key, "left_semi")


def _grams(text: Column, length: int) -> Column:
    places = F.when(F.length(text) >= length, F.sequence(F.lit(1), F.length(text) - (length - 1)))
    return F.coalesce(F.transform(places, lambda at: F.concat(F.lit(f"{length}:"), F.substr(text, at, F.lit(length)))), F.array().cast("array<string>"))


def _run_grams(pattern: Column, length: int) -> Column:
    """Grams of all literal runs; an escape ends a run, so no gram ever holds one."""
    runs = F.regexp_extract_all(pattern, F.lit(rf"[^_%\\]{{{length},}}"), F.lit(0))
    return F.flatten(F.transform(runs, lambda run: _grams(run, length)))


def _unmatched_patterns(links: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Anti join on LIKE over an index of grams, without comparing all pairs.

    A match holds every literal run of its pattern, so it holds every gram of it. Each
    pattern is compared with the stored values that hold its rarest one: the
    grams (``GRAMS`` characters, the longest a pattern has) of all patterns are counted over the stored
    values, and those that occur nowhere settle their patterns at once. A gram
    that more than ``PER_BLOCK`` values hold is split by a salt, which its patterns
    take all values of. Patterns without a gram meet every value, under as many salts.
    A pattern with no wildcard is looked up by plain equality.
    """
    pattern = F.col("_pattern")
    distinct = links.select(F.col(key).alias("_pattern")).filter("_pattern is not null").distinct()
    wild = pattern.rlike(r"[_%\\]")
    plain = distinct.filter(~wild).join(stored.select(F.col("stored").alias("_pattern")), "_pattern", "left_semi")
    of_length = [_run_grams(pattern, n) for n in GRAMS]
    chosen = F.lit(None).cast("array<string>")
    for grams in reversed(of_length):
        chosen = F.when(F.size(grams) > 0, F.array_distinct(grams)).otherwise(chosen)
    patterns = distinct.filter(wild).withColumn("_grams", F.coalesce(chosen, F.array(F.lit(""))))
    wanted = patterns.select("_pattern", F.explode("_grams").alias("_gram"))
    offers = F.concat(F.array(F.lit("")), *[_grams(F.col("stored"), n) for n in GRAMS])
    held = (
        stored.filter("stored is not null").distinct()
        .select("stored", F.explode(F.array_distinct(offers)).alias("_gram"))
        .join(wanted.select("_gram").distinct(), "_gram", "left_semi")
    )
    counts = held.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    # A pattern whose rarest gram is nowhere has no match: it comes out of the left join with no count.
    rarest = (
        wanted.join(counts, "_gram", "left").groupBy("_pattern")
        .agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_gram").alias("gram"))).alias("_least"))
        .filter("_least.n > 0")
    )
    salts = F.ceil(F.col("_least.n") / PER_BLOCK).cast("int")
    probe = rarest.select("_pattern", F.col("_least.gram").alias("_gram"), F.explode(F.sequence(F.lit(1), salts)).alias("_salt"))
    blocks = rarest.select(F.col("_least.gram").alias("_gram"), salts.alias("_salts")).distinct()
    values = held.join(blocks, "_gram").select("_gram", "stored", (F.pmod(F.xxhash64("stored"), F.col("_salts")) + 1).cast("int").alias("_salt"))
    met = probe.alias("p").join(values.alias("v"), (F.col("p._gram") == F.col("v._gram")) & (F.col("p._salt") == F.col("v._salt")) & F.expr("v.stored LIKE p._pattern"), "left_semi")
    matched = met.select("_pattern").unionByName(plain)
    return links.join(matched.distinct(), F.col(key) == F.col("_pattern"), "left_anti")


def first_by_key(rows: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in a total order.

    The row number limit is applied before the shuffle as well as after it, so
    each task hands on one row per key whatever the number of copies.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ranked = rows.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def until_first_seen(
    links: DataFrame,
    store: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    key: str = "url_key",
    accepted: Column | None = None,
    run_order: Sequence[str] | None = None,
) -> DataFrame:
    """Keep each listing's links up to the first one seen before.

    Seen means stored already, or accepted earlier: an earlier item with the
    same key counts unless it was rejected (``accepted`` false). Earlier is
    meant within the listing, or, given the ``run_order`` in which a run comes
    to its links, in any listing of the run.
    Links behind their own listing's stop are never come to, so they make no
    address seen. The stopping place of a listing is an aggregate, so no listing is sorted in
    one task; ``order`` must be unique within a listing, and a run comes to a listing's links in
    that order. Listings are told apart by all of ``by``, NULLs included; links without an address are
    never seen.
    """
    # A single column keeps the aggregates below in hash tables.
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    ok = F.lit(True) if accepted is None else F.coalesce(accepted, F.lit(False))
    turn = place if run_order is None else F.struct(*run_order)
    narrow = links.select(*by, key, place.alias("_place"), turn.alias("_turn"), ok.alias("_ok"))
    firsts = narrow.groupBy(*by, key).agg(F.min("_place").alias("_first"))
    stored = firsts.join(store.select(key), key, "left_semi").groupBy(*by).agg(F.min("_first").alias("_stop"))
    # Links whose address comes twice and is accepted once at least: they alone can stop a listing.
    scope = [key] if run_order is not None else [*by, key]
    counts = narrow.filter(F.col(key).isNotNull()).groupBy(*scope).agg(F.max("_ok").alias("_any"), F.count(F.lit(1)).alias("_n"))
    repeated = _same(narrow, counts.filter("_n > 1 and _any").select(*scope), scope, "left_semi")
    stops = _next_stops(repeated, stored, stored if run_order is not None else None, by, scope)
    if run_order is not None:
        stops = _settled(repeated, stored, stops, by, scope)
    kept = _same(links, stops, by, "left")
    return kept.filter(F.col("_stop").isNull() | (place < F.col("_stop"))).drop("_stop")


def _same(left: DataFrame, right: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Join on columns that may be NULL on both sides; the left ones stay."""
    renamed = right.select(*[F.col(c).alias(f"_by_{c}" if c in names else c) for c in right.columns])
    on = [left[c].eqNullSafe(renamed[f"_by_{c}"]) for c in names]
    joined = left.join(renamed, on, how)
    return joined.drop(*[f"_by_{c}" for c in names])


def _next_stops(repeated: DataFrame, stored: DataFrame, stops: DataFrame | None, by: Sequence[str], scope: Sequence[str]) -> DataFrame:
    """Stops of all listings, if the links before ``stops`` are the ones taken (all of them, without)."""
    taken = repeated.filter("_ok")
    if stops is not None:
        taken = _same(taken, stops, by, "left").filter(F.col("_stop").isNull() | (F.col("_place") < F.col("_stop"))).drop("_stop")
    first = taken.groupBy(*scope).agg(F.min("_turn").alias("_taken"))
    again = _same(repeated, first, scope, "inner").filter(F.col("_turn") > F.col("_taken"))
    found = again.select(*by, F.col("_place").alias("_stop")).unionByName(stored)
    return found.groupBy(*by).agg(F.min("_stop").alias("_stop"))


def _settled(repeated: DataFrame, stored: DataFrame, stops: DataFrame, by: Sequence[str], scope: Sequence[str]) -> DataFrame:
    """The stops that agree with the links they leave to be taken.

    A link counts as taken only if it stands before its own listing's stop. Later stops let
    more links be taken, which makes stops earlier, so rounds give bounds in turn: the stored stops
    are the latest possible, what follows from them the earliest, and so on. Each round
    settles at least the first listing still open; the bounds meet in the stops of a run that
    reads its links one by one. Every round is cut off from the ones before it.
    """
    repeated, stored, before = durable(repeated), durable(stored), None
    while True:
        stops = durable(stops)
        digest = F.sum(F.xxhash64(*by, "_stop").cast("decimal(38,0)"))
        now = tuple(stops.agg(F.count(F.lit(1)), digest).first())
        if now == before:
            return stops
        before, stops = now, _next_stops(repeated, stored, stops, by, scope)


def winners(batch: DataFrame, store: DataFrame, row_id: str, order: Sequence[str], key: str = "url_key", reason: str = "reject_reason") -> DataFrame:
    """``row_id`` of the rows an insert adds: accepted, new and first of their key."""
    columns = list(dict.fromkeys([row_id, key, *order]))
    accepted = batch.filter(F.col(reason).isNull()).select(*columns)
    return first_by_key(accepted, key, order).join(store.select(key), key, "left_anti").select(row_id)


def mark_outcome(batch: DataFrame, won: DataFrame, row_id: str, reason: str = "reject_reason") -> DataFrame:
    outcome = F.when(F.col(reason).isNotNull(), "rejected").when(F.col("_won"), "inserted").otherwise("duplicate")
    marked = batch.join(won.withColumn("_won", F.lit(True)), row_id, "left")
    return marked.withColumn("outcome", outcome).drop("_won")


def load_outcome(
    batch: DataFrame,
    store: DataFrame,
    row_id: str,
    order: Sequence[str],
    key: str = "url_key",
    reason: str = "reject_reason",
) -> DataFrame:
    """Mark each row of a batch ``inserted``, ``duplicate`` or ``rejected``.

    Only narrow rows are ranked and joined with the store; the batch itself is
    joined on its unique ``row_id``, which no hot key can skew. The batch is
    read twice: cut its lineage first where it is costly to compute.
    """
    return mark_outcome(batch, winners(batch, store, row_id, order, key, reason), row_id, reason)
