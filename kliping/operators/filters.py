"""Rules that keep or reject rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
BADGE_WORDS = ["foto", "video"]
ARTICLE_COLUMNS = [
    "post_id", "author", "pubdate", "category", "subcategory", "content",
    "comments", "images", "title", "tags", "url", "source",
]
# -----------------------------------------------------------------------------


def mentions(text: Column, words: Sequence[str]) -> Column:
    """True where the text holds one of the words, in any case; never NULL."""
    lowered = F.lower(text)
    hit = reduce(lambda a, b: a | b, [lowered.contains(w.lower()) for w in words])
    return F.coalesce(hit, F.lit(False))


def drop_badges(df: DataFrame, badge: str, words: Sequence[str] = BADGE_WORDS) -> DataFrame:
    """Drop listing items by their badge; an item without one is kept."""
    return df.filter(~mentions(F.col(badge), words))


def drop_mentions(df: DataFrame, columns: Sequence[str], words: Sequence[str]) -> DataFrame:
    """Drop rows where any of the columns mentions one of the words."""
    return df.filter(~reduce(lambda a, b: a | b, [mentions(F.col(c), words) for c in columns]))


def on_date(df: DataFrame, stamp: str, date: Column) -> DataFrame:
    """Rows of one day, as a range of the column so that it reaches the scan."""
    kind = df.schema[stamp].dataType
    return df.filter((F.col(stamp) >= date.cast(kind)) & (F.col(stamp) < F.date_add(date, 1).cast(kind)))


def reject_reason(required: Mapping[str, Column]) -> Column:
    """Name of the first requirement that does not hold, else NULL."""
    reason = F.lit(None).cast("string")
    for name, present in reversed(required.items()):
        reason = F.when(F.coalesce(present, F.lit(False)), reason).otherwise(F.lit(name))
    return reason


def quarantine(df: DataFrame, required: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split into kept rows and rejected rows with their reason."""
    marked = df.withColumn("reject_reason", reject_reason(required))
    kept = marked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return kept, marked.filter(F.col("reject_reason").isNotNull())


def project_article(df: DataFrame) -> DataFrame:
    """The fixed twelve columns; absent values become '' or 0, dates stay NULL."""
    have = set(df.columns)

    def pick(name: str) -> Column:
        if name == "pubdate":
            return (F.col(name) if name in have else F.lit(None)).cast("timestamp").alias(name)
        if name == "post_id":
            return F.col(name).cast("bigint").alias(name)
        if name == "comments":
            return F.coalesce((F.col(name) if name in have else F.lit(None)).cast("int"), F.lit(0)).alias(name)
        return F.coalesce((F.col(name) if name in have else F.lit(None)).cast("string"), F.lit("")).alias(name)

    return df.select(*[pick(name) for name in ARTICLE_COLUMNS])


def code_label(df: DataFrame, code: str, labels: DataFrame, label_code: str, label: str, other: str) -> DataFrame:
    """Add ``label`` for a code; codes the table does not know get ``other``.

    The join carries no hint: Spark broadcasts the label table when its
    measured size allows, and shuffles otherwise.
    """
    named = labels.select(F.col(label_code).alias("_code"), F.col(label).alias("_label"))
    return (
        df.join(named, F.col(code) == F.col("_code"), "left")
        .withColumn("label", F.coalesce("_label", F.lit(other)))
        .drop("_code", "_label")
    )
