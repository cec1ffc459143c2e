"""A training corpus in five stages, each on the whole of what its predecessor kept.

Toxic documents go; later repeats of runs of three lines, or of fewer that hold
25 words, are cut out of the texts, and documents without any line left go; one row of each near-duplicate group
stays; documents with a benchmark passage go; the rest is encoded into sampled
segmentations, and each is decoded again and held against its text. All but the last stage return the columns of ``documents``.

Documents without text (null or empty) are neither toxic nor contaminated and have no lines to lose, so they stay, and are
encoded into no pieces. Rows without an id are judged by their text like all others; of a near-duplicate group exactly one row
stays, also where ids are null, repeated or tied (the smallest id, then the smallest row). Very long texts are
worked on whole. Further columns pass through every stage but the last, whatever their names. An empty table gives an empty
table in every stage. Near duplicates are judged on shingles of five words, as everywhere but in the query ``op7_near_duplicates``,
whose contract asks for four.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kliping.llm import decontaminate, line_dedup, near_dedup, segmentation, toxicity
from kliping.llm.queries import held_out
from kliping.llm.shared import stored
from kliping.session import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    return toxicity.without_toxic(docs, toxicity.fitted(docs, labels))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked, lost = line_dedup.marked(docs, words=line_dedup.WORDS)
    left = marked.filter(~F.coalesce(line_dedup.depleted(F.col("text"), lost), F.lit(False)))
    text = line_dedup.kept_text(F.col("text"), lost)
    changed = {"text": text, "n_chars": F.when(F.size(lost) == 0, F.col("n_chars")).otherwise(F.length(text).cast("long"))}
    return left.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Earlier stages' Python workers still hold memory here, so the groups are small.
    return segmentation.encoded(docs, group=250_000, verify=True).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", without_near_duplicates),
    ("benchmark_decontamination", without_benchmarks),
    ("segmentation", encoded),
]

# Learned scores, sketches and sampled segmentations are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
