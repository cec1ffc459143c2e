"""One query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kliping.llm import conversations, decontaminate, language_model, line_dedup, near_dedup, quality, ranked_search, secrets, segmentation, sharding, substring_dedup, toxicity, warc
from kliping.llm.registry import query
from kliping.llm.shared import new_path
from kliping.session import table


@query("op1_line_dedup", line_dedup.deduplicated_sql())
def line_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, lost = line_dedup.marked(table(spark, sf_dir, "documents"))
    text = F.col("text")
    return docs.select(
        "doc_id", F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n", -1))).cast("long").alias("n_lines"),
        F.size(lost).cast("long").alias("n_deleted"),
        F.sha2(F.coalesce(line_dedup.kept_text(text, lost), F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


@query("op2_segmentation")
def sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = segmentation.encoded(table(spark, sf_dir, "documents"), checksum=True)
    return rows.select(
        F.col("id").alias("doc_id"), "sample", F.size("pieces").cast("long").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_hash"), "log_prob", "log_inclusion", "text_crc32",
    )


@query("op3_secrets")
def secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fitted(docs)).withColumnRenamed("id", "doc_id")


@query("op4_decontamination")
def benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
        F.size("near").cast("long").alias("n_near_items"),
    )


@query("op5_quality")
def quality_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def held_out() -> F.Column:
    """Whether the row's label may not be learned from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


@query("op6_toxicity")
def toxic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    grammar = toxicity.fitted(docs, labels.filter(~held_out()))
    scores = toxicity.scored(docs, grammar).withColumnRenamed("id", "doc_id")
    return scores.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query("op7_near_duplicates")
def near_duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_dedup.grouped(table(spark, sf_dir, "documents"), shingle=4)
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@query("op8_sharding")
def sharding_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shuffled(table(spark, sf_dir, "documents"), shards=24)
    return rows.select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard",
        "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op9_warc")
def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op10_substring_dedup")
def repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_spans(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256", "n_passage_words"
    )


@query("op13_ranked_search", ranked_search.ranked_sql())
def best_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_conversation_repair")
def repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    results = conversations.repaired(conversations.damaged(rows))
    return conversations.with_every_conversation(results, rows).withColumnRenamed("conv", "conv_id")


@query("op12_language_model")
def text_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1
    return language_model.scored(table(spark, sf_dir, "documents"), held).withColumnRenamed("id", "doc_id")
