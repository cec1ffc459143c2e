"""Session settings, table access and durable cut points."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Pages reach tens of kB each, so Arrow batches are kept small; skewed joins
# are split by adaptive execution even where that costs one more shuffle.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


PARTITION_BYTES = 128 * 1024**2


def shuffle_partitions(input_bytes: int) -> int:
    """Shuffle partitions of about ``PARTITION_BYTES`` for an input of that size.

    Adaptive execution joins small ones, so the number errs on the high side.
    """
    return max(200, -(-input_bytes // PARTITION_BYTES))


def build_session(
    app: str = "kliping", master: str | None = None, input_bytes: int | None = None, **extra: str
) -> SparkSession:
    """A session with the settings above; ``extra`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if input_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes)))
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, or else one in the warehouse; all executors must share it.

    A warehouse on a machine's own disk is refused where the executors are on others.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.sparkContext.master.startswith("local") and (warehouse.startswith("file:") or "://" not in warehouse):
        raise ValueError("set spark.checkpoint.dir: the executors do not share the warehouse, a folder of the driver")
    return f"{warehouse}/checkpoints"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` into the shared checkpoint folder.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; without
    that setting it is one in the warehouse, which all executors share too.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
