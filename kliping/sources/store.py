"""The article store: Parquet partitioned by source and publishing day, its files alive by a manifest of commits."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from kliping.functions import urls
from kliping.operators import dedupe, repair
from kliping.session import durable
from kliping.sources import keys, manifest
from kliping.sources.files import EMPTY, PARTITIONS, STORED, read_files

SMALL_BYTES = 32 * 1024**2
FILE_BYTES = 256 * 1024**2


def read_store(spark: SparkSession, path: str, predicate: Column | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Scan the store as its last commit left it; an absent one is empty."""
    rows = read_files(spark, path, manifest.live(spark, path))
    if predicate is not None:
        rows = rows.filter(predicate)
    return rows.select(*columns) if columns else rows


def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A store kept in a database: the predicate travels inside ``query``."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def with_keys(rows: DataFrame) -> DataFrame:
    return rows.withColumn("url_key", urls.canonical(F.col("url"))).withColumn("pub_date", F.to_date("pubdate"))


def _folder(spark: SparkSession, source: str | None, day: object) -> str:
    named = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    source = EMPTY if source == "" else source
    return "/".join([named("source", source), named("pub_date", None if day is None else str(day))])


def _folders(rows: DataFrame) -> list[str]:
    """Folders of the partitions that rows belong to, one value per partition."""
    return sorted({_folder(rows.sparkSession, r.source, r.pub_date) for r in rows.select(*PARTITIONS).distinct().collect()})


def write_files(rows: DataFrame, path: str) -> list[str]:
    """Write rows into files no reader follows yet; each partition in files of even size.

    The rebalance hint gathers small partitions and splits large ones, so one
    source that holds most rows is still written by many tasks. ``rows`` is
    read twice: cut its lineage first.
    """
    spark, mark = rows.sparkSession, f"c{uuid.uuid4().hex}"
    folders = _folders(rows)
    if folders:
        _write(rows.hint("rebalance", *PARTITIONS), path, mark)
    return _marked(spark, path, folders, mark)


def _write(rows: DataFrame, path: str, mark: str) -> None:
    named = rows.withColumn("source", F.when(F.col("source") == "", EMPTY).otherwise(F.col("source")))
    named.write.mode("append").option("mapreduce.output.basename", mark).partitionBy(*PARTITIONS).parquet(path)


def _marked(spark: SparkSession, path: str, folders: Sequence[str], mark: str) -> list[str]:
    return [f"{f}/{name}" for f in folders for name in manifest.names(spark, path, f) if name.startswith(f"{mark}-")]


def append(rows: DataFrame, path: str) -> None:
    """Add rows in one commit."""
    manifest.commit(rows.sparkSession, path, write_files(durable(rows), path))


def overwrite_partitions(rows: DataFrame, path: str) -> None:
    """Replace just the partitions ``rows`` has rows for, in one commit."""
    spark, rows = rows.sparkSession, durable(rows)
    folders = set(_folders(rows))
    old = [f for f in manifest.live(spark, path) if f.rsplit("/", 1)[0] in folders]
    manifest.commit(spark, path, write_files(rows, path), old)


def insert_if_absent(
    batch: DataFrame, path: str, row_id: str, order: Sequence[str] | None = None, checked: int | None = None
) -> DataFrame:
    """Append the articles whose address is not stored; return the outcomes.

    ``batch`` has the article columns, a unique ``row_id`` and maybe a
    ``reject_reason``. Of several rows with one address the first in ``order``
    (default: by ``row_id``) goes in; rows without an address are rejected as
    ``no_address``. The batch and the numbers of the rows to add are written
    to the checkpoint folder before the store changes, so the batch is computed
    once, and the append and the returned frame agree whatever is run again; a
    repeated call inserts nothing. Stored addresses come from the key index.
    With ``checked``, no address of the batch was stored at that version. If
    another writer commits in between, the addresses are compared again.
    """
    spark, rows = batch.sparkSession, with_keys(batch)
    if "reject_reason" not in rows.columns:
        rows = rows.withColumn("reject_reason", F.lit(None).cast("string"))
    nowhere = F.coalesce(F.col("url_key"), F.lit("")) == ""
    rows = durable(rows.withColumn("reject_reason", F.coalesce("reject_reason", F.when(nowhere, "no_address"))))
    while True:
        at = manifest.version(spark, path)
        stored = keys.stored(rows.select("url_key"), path) if checked is None or checked != at else rows.select("url_key").limit(0)
        won = durable(dedupe.winners(rows, stored, row_id, order or [row_id]))
        marked = dedupe.mark_outcome(rows, won, row_id)
        files = write_files(marked.filter(F.col("outcome") == "inserted").select(*STORED.fieldNames()), path)
        if not files or manifest.commit(spark, path, files, expect=at):
            return marked.select(row_id, "url", "source", "reject_reason", "outcome")
        checked = None


def repair_partitions(store: DataFrame, fixes: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Put fixes, keyed by address, into the stored partitions they touch.

    Partitions without a fix are neither read (but for their keys) nor written.
    The merged rows go into new files, those with a repaired date into the
    partition they move to; then one commit replaces the files of the touched
    partitions. A job that dies before it has changed nothing.
    """
    if set(columns) & set(PARTITIONS):
        raise ValueError("a repair cannot set the columns the store is partitioned by")
    spark = store.sparkSession
    wanted = durable(fixes.select("url_key", *columns))
    folders = set(_folders(store.join(wanted.select("url_key"), "url_key", "left_semi")))
    old = [f for f in manifest.live(spark, path) if f.rsplit("/", 1)[0] in folders]
    merged = repair.merge(read_files(spark, path, old), wanted, "url_key", columns)
    merged = durable(merged.withColumn("pub_date", F.to_date("pubdate")).select(*STORED.fieldNames()))
    manifest.commit(spark, path, write_files(merged, path), old, new=False)


def compact(spark: SparkSession, path: str, small_bytes: int = SMALL_BYTES, file_bytes: int = FILE_BYTES) -> int:
    """Put the small files of each partition together, first fit by falling size, in one commit; the number of files saved.

    Large files are left alone. The sizes of the small files, one row each, are
    looked up beside the rows by file name.
    """
    sizes: dict[str, list[tuple[int, str]]] = {}
    for name, size in manifest.sizes(spark, path, manifest.live(spark, path)):
        if size < small_bytes:
            sizes.setdefault(name.rsplit("/", 1)[0], []).append((size, name))
    bins: list[tuple[str, int]] = []
    planned = 0
    for files in sizes.values():
        free: list[int] = []
        of = []
        for size, name in sorted(files, reverse=True):
            at = next((k for k, room in enumerate(free) if room >= size), len(free))
            if at == len(free):
                free.append(max(file_bytes, size))
            free[at] -= size
            of.append((name, at))
        held = [at for _, at in of]
        joined = [(name, planned + at) for name, at in of if held.count(at) > 1]  # a bin of one file is as it should be
        bins += joined
        planned += len(free)
    if not bins:
        return 0
    where = spark.createDataFrame([(name.rsplit("/", 1)[1], at) for name, at in bins], "_file string, _bin long")
    old = [name for name, _ in bins]
    rows = read_files(spark, path, old, F.col("_metadata.file_name").alias("_file"))
    mark = f"c{uuid.uuid4().hex}"
    count = len({at for _, at in bins})
    _write(rows.join(where, "_file").repartition(count, "_bin").select(*STORED.fieldNames()), path, mark)
    new = _marked(spark, path, sorted({name.rsplit("/", 1)[0] for name in old}), mark)
    manifest.commit(spark, path, new, old, new=False)
    return len(old) - len(new)


# -- dumps ---------------------------------------------------------------------

NULL_CELL = r"\N"  # an empty cell is an empty text
FILE_ROWS = 100_000  # one task reads a file
KEEP_BLANKS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def with_index(rows: DataFrame, row_id: str, name: str = "_index") -> DataFrame:
    """A gapless index from 0 in the order of a unique column.

    The ids alone are range partitioned and written to the checkpoint folder,
    so that their partitions stay the same; inside a partition they are
    numbered, and shifted by the sizes of the partitions before it. Only one
    number per partition meets in one task.
    """
    ranged = durable(rows.select(row_id).repartitionByRange(F.col(row_id)).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    shifts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_shift"))
    inside = F.row_number().over(W.partitionBy("_part").orderBy(row_id))
    numbered = (
        ranged.withColumn("_inside", inside)
        .join(shifts, "_part")
        .select(row_id, (F.col("_shift") + F.col("_inside") - 1).alias(name))
    )
    return rows.join(numbered, row_id)


def write_dump(rows: DataFrame, path: str, row_id: str) -> None:
    """CSV with a leading index column."""
    indexed = with_index(rows, row_id)
    indexed.select(F.col("_index"), *rows.columns).write.mode("overwrite").option("header", True).option(
        "escape", '"'
    ).options(nullValue=NULL_CELL, maxRecordsPerFile=FILE_ROWS, **KEEP_BLANKS).csv(path)


def read_dump(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A dump in good form; cells may be quoted and hold line feeds, so each file is read by one task."""
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"', nullValue=NULL_CELL, **KEEP_BLANKS)


def rescue_dump(rows: DataFrame, cell: str) -> tuple[DataFrame, DataFrame]:
    """Articles out of cells that hold a record as dictionary text.

    Single-quoted JSON is accepted as it is, and the older key ``image`` is read
    as ``images``. Cells that do not parse go to the second frame whole.
    """
    shape = (
        "id BIGINT, author STRING, pubdate STRING, category STRING, subcategory STRING, content STRING, "
        "comments INT, image STRING, images STRING, title STRING, tags STRING, url STRING, source STRING"
    )
    parsed = rows.withColumn("_r", F.from_json(F.col(cell), shape, {"mode": "PERMISSIVE"}))
    good = F.col("_r.url").isNotNull()
    record = F.col("_r")
    rescued = parsed.filter(good).select(
        *rows.drop(cell).columns,
        record["id"].alias("post_id"),
        record["author"].alias("author"),
        F.try_to_timestamp(record["pubdate"], F.lit("yyyy-MM-dd HH:mm:ss")).alias("pubdate"),
        record["category"].alias("category"),
        record["subcategory"].alias("subcategory"),
        record["content"].alias("content"),
        record["comments"].alias("comments"),
        F.coalesce(record["images"], record["image"]).alias("images"),
        record["title"].alias("title"),
        record["tags"].alias("tags"),
        record["url"].alias("url"),
        record["source"].alias("source"),
    )
    return rescued, parsed.filter(~F.coalesce(good, F.lit(False))).drop("_r")


# -- run state -----------------------------------------------------------------


def latest_run_state(states: DataFrame, by: Sequence[str] = ("site", "category"), stamp: str = "written_at") -> DataFrame:
    """The last written state per key, by a partial aggregate."""
    rest = [c for c in states.columns if c not in by and c != stamp]
    last = F.max(F.struct(stamp, *rest)).alias("_last")
    return states.groupBy(*by).agg(last).select(*by, "_last.*")


def save_run_state(states: DataFrame, path: str) -> None:
    states.write.mode("append").parquet(path)
