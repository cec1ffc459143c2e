"""The addresses of a store in buckets, so that an insert need not read the store.

A Parquet table ``_keys`` inside the store holds every stored address, bucketed and sorted
by it. A batch is shuffled to the buckets and merged with them; the stored side is
never shuffled. The addresses of a small batch also go in as literals, so that only
the buckets they fall into are read.

The index follows the manifest: a file ``_manifest/<version>.keys`` says up to which
commit it is complete, and it is brought up to date before it is asked. It only
ever takes in addresses of committed rows, so an update that dies leaves at worst some of
them twice, which no anti join minds. Addresses of rows that are gone for good may
stay; ``rebuild`` starts the index anew.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kliping.sources import manifest
from kliping.sources.files import read_files

FOLDER = "_keys"
BUCKETS = 64
LITERALS = 500


def _state(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Version up to which the index is complete, and its folder and number of buckets."""
    names = [n for n in manifest.names(spark, path, manifest.LOG) if n.endswith(".keys")]
    return (int(names[-1][:20]), manifest.read(spark, path, names[-1])) if names else (-1, {})


def _table(spark: SparkSession, path: str, state: dict) -> str:
    """The table of the session's catalog that stands for the index folder."""
    where = f"{path}/{state['folder']}"
    name = "kliping_keys_" + hashlib.sha256(where.encode()).hexdigest()[:24]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (url_key STRING) USING parquet "
        f"CLUSTERED BY (url_key) SORTED BY (url_key) INTO {state['buckets']} BUCKETS LOCATION '{where}'"
    )
    spark.sql(f"REFRESH TABLE {name}")
    return name


def update(spark: SparkSession, path: str, buckets: int = BUCKETS) -> str | None:
    """Take in the addresses of all commits since the last update; the table, or None for a store without files."""
    covered, state = _state(spark, path)
    last, files = manifest.added_since(spark, path, max(covered, 0))
    if not last and not files:
        return None
    if covered < 0:
        files = manifest.live(spark, path)
        state = {"folder": f"{FOLDER}/{uuid.uuid4().hex}", "buckets": buckets}
    name = _table(spark, path, state)
    if covered < last or not last:
        rows = read_files(spark, path, files).select("url_key").filter("url_key is not null")
        spread = rows.repartition(state["buckets"], "url_key").sortWithinPartitions("url_key")
        spread.write.mode("append").insertInto(name)
        if last:
            manifest.write(spark, path, f"{last:020d}.keys", state)
        spark.sql(f"REFRESH TABLE {name}")
    return name


def rebuild(spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
    """A new index of the rows that are alive, in few files; switched over to by its state file."""
    last = manifest.version(spark, path) or manifest.commit(spark, path, [])
    state = {"folder": f"{FOLDER}/{uuid.uuid4().hex}", "buckets": buckets}
    rows = read_files(spark, path, manifest.live(spark, path, last)).select("url_key").filter("url_key is not null").distinct()
    rows.repartition(buckets, "url_key").sortWithinPartitions("url_key").write.mode("append").insertInto(_table(spark, path, state))
    manifest.write(spark, path, f"{last:020d}.keys", state, replace=True)


def stored(wanted: DataFrame, path: str, buckets: int = BUCKETS) -> DataFrame:
    """``url_key`` of the stored addresses, at least of those in ``wanted``."""
    spark = wanted.sparkSession
    name = update(spark, path, buckets)
    if name is None:
        return wanted.select("url_key").limit(0)
    few = [r.url_key for r in wanted.filter("url_key is not null").select("url_key").distinct().limit(LITERALS + 1).collect()]
    found = spark.table(name)
    return found.filter(F.col("url_key").isin(few)) if len(few) <= LITERALS else found
