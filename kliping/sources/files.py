"""Data files of the article store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kliping.schema import ARTICLE

PARTITIONS = ["source", "pub_date"]
STORED = T.StructType([*ARTICLE.fields, T.StructField("url_key", T.StringType()), T.StructField("pub_date", T.DateType())])
EMPTY = "__EMPTY__"  # Spark writes an empty partition value as NULL; this one keeps them apart


def read_files(spark: SparkSession, path: str, files: Sequence[str], *more: Column) -> DataFrame:
    """Rows of some files of the store, relative to it, and columns made of them.

    Files of articles without a source are read apart, so that a predicate on the source still prunes the others.
    """
    if not files:
        return spark.createDataFrame([], STORED).select("*", *[F.lit(None).alias("_") for _ in more])
    nowhere = [f for f in files if f.startswith(f"source={EMPTY}/")]
    named = [f for f in files if not f.startswith(f"source={EMPTY}/")]
    parts = []
    for group in (named, nowhere):
        if group:
            rows = spark.read.schema(STORED).option("basePath", path).parquet(*[f"{path}/{name}" for name in group]).select("*", *more)
            parts.append(rows.withColumn("source", F.lit("")) if group is nowhere else rows)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
