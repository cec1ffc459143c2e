"""Tables kept in the cluster's shared folder, and row-wise Arrow steps."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructField, StructType

from kliping.session import shared_folder

SLICE = 512  # rows handled at once inside a task
SLICE_BYTES = 8 << 20  # and bytes of texts


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage and survives lost executors. The folder's owner clears
    old tables; every call takes a new one.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` has written and nothing will read again, and shuffle files of jobs that are done.

    Spark drops the latter once the driver's collector has run, which a driver with a roomy heap puts off.
    """
    for df in tables:
        spark = df.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs
        ours = hadoop.Path(shared_folder(spark)).toUri().getPath()
        for parent in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = hadoop.Path(parent)
            if path.toUri().getPath().startswith(ours + "/"):
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        gc.collect()
        tables[0].sparkSession._jvm.System.gc()


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(df: DataFrame) -> DataFrame:
    """Texts may be long, so no more than ``SLICE`` rows of a session's tables go to Python at once."""
    spark = df.sparkSession
    if not 0 < int(spark.conf.get(BATCH_ROWS)) <= SLICE:
        spark.conf.set(BATCH_ROWS, str(SLICE))
    return df


def released() -> None:
    """Give memory back that a task no longer needs; its Python worker lives on and serves other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices_of(batch: pa.RecordBatch, size: int, slice_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows, at most ``size`` and, unless one row alone is larger, ``slice_bytes`` of texts."""
    weight = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type):
            weight += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(weight)
    at = 0
    while at < batch.num_rows:
        room = (total[at - 1] if at else 0) + slice_bytes
        end = min(at + size, max(at + 1, int(np.searchsorted(total, room, "right"))))
        yield batch.slice(at, end - at)
        at = end


def map_slices(
    df: DataFrame, fn: Callable[[list[list]], list[list]], schema: StructType, size: int = SLICE
) -> DataFrame:
    """Apply ``fn`` to slices of ``size`` rows or fewer within tasks; columns go in as lists and come out as lists or Arrow arrays."""
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_of(batch, size):
                columns = fn([c.to_pylist() for c in part.columns])
                if len(columns[0]):
                    yield pa.RecordBatch.from_arrays(
                        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out
                    )
                del columns
        released()

    return in_small_batches(df).mapInArrow(run, schema)


def schema_of(**types: str | DataType) -> StructType:
    """A schema from names and types, the latter as SQL text or as they are."""
    return StructType(
        [StructField(n, t if isinstance(t, DataType) else StructType.fromDDL(f"x {t}")[0].dataType) for n, t in types.items()]
    )


def without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents, same columns, whose ``id`` and text ``digest`` are not in ``gone``."""
    gone = gone.select(F.col("id").alias("_gone_id"), F.col("digest").alias("_gone_digest"))
    same = docs[id_col].eqNullSafe(F.col("_gone_id")) & (F.xxhash64(docs[text_col]) == F.col("_gone_digest"))
    return docs.join(gone, same, "left_anti")
