"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kliping.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, of every node in ``edges`` (columns ``a``, ``b``, longs).

    Alternating stars: each node hands its neighbours on to the smallest of
    them, until every edge leads to a root. Neighbours are never gathered in
    one place; a node with many is a skewed join key, which Spark splits. Every
    pass is stored, so a lost executor costs one pass.
    """
    edges = edges.select("a", "b").filter("a <> b").distinct()
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select("b", "m").filter("b <> m").distinct()
        down = large.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        star = F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m")))
        small = down.join(least, "a").select(star.alias("x")).select(F.col("x.b").alias("a"), F.col("x.m").alias("b"))
        edges = stored(small.filter("a <> b").distinct(), "edges")
        # Count and checksum tell whether a pass changed anything.
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).collect()[0]
        if tuple(now) == before or not now[0]:
            break
        before = tuple(now)
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    own = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(own)
