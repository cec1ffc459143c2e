"""Raw page sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kliping.schema import PAGE


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE).parquet(path)


def read_html_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per saved file, whole text, the file address as ``url``."""
    return spark.read.text(path, wholetext=True).select(
        F.xxhash64(F.col("_metadata.file_path")).alias("page_id"),
        F.col("_metadata.file_path").alias("url"),
        F.col("value").alias("html"),
    )


def envelope(body: Column, field: str = "html") -> Column:
    """The markup inside a JSON envelope."""
    return F.from_json(body, f"`{field}` STRING").getField(field)


def unwrap_envelope(df: DataFrame, body: str, field: str = "html") -> DataFrame:
    """Replace a JSON envelope by the markup inside; empty ones give no row."""
    return df.withColumn(field, envelope(F.col(body), field)).filter(F.col(field) != "")


def script_value(html: Column, pattern: str) -> Column:
    """A value out of an inline script; NULL when the pattern is absent."""
    return F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))


def state_links(df: DataFrame, html: str) -> DataFrame:
    """Links in the page-state JSON, without the first list entry."""
    state = script_value(F.col(html), r"(?s)window\.__NUXT__\s*=\s*(\{.*?\});?\s*</script>")
    shape = "data ARRAY<STRUCT<listarticle: ARRAY<STRUCT<articleUrl: STRING>>>>"
    listed = F.get(F.from_json(state, shape).getField("data"), 0).getField("listarticle")
    rest = F.slice(listed, F.lit(2), F.greatest(F.size(listed) - 1, F.lit(0)))
    return df.select("*", F.posexplode(rest.getField("articleUrl")).alias("pos", "link"))
