"""The registered queries and the pipeline's stages on the smallest tables."""

import warnings

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kliping.llm import decontaminate, segmentation
from kliping.llm.registry import ORACLE, QUERIES, load_all
from kliping.llm.shared import stored
from kliping.session import table
from tests.oracle import compare, connect

load_all()
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, name):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert compare(spark, connect(SF), name, QUERIES[name], ORACLE[name], SF) is None


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == [*range(1, 14)]


def test_line_dedup_is_native(spark):
    for name in ("op1_line_dedup", "op8_sharding"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_stages(spark):
    docs = table(spark, SF, "documents")
    kept = {r.doc_id for r in docs.collect()}
    columns, toxic = docs.columns, {r.doc_id for r in table(spark, SF, "labels").filter("toxic = 0").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), name)
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and left < kept | {None} and len(left) > 0.7 * len(kept)
        if name == "toxicity":
            assert toxic <= left
        kept = left
    assert docs.filter(F.length("text") != F.col("n_chars")).count() == 0
    assert decontaminate.search(docs, table(spark, SF, "benchmark")).filter("contaminated").count() == 0
    pieces = corpus_pipeline.encoded(spark, docs, SF)
    texts = segmentation.decoded(pieces).filter("sample = 1").select("doc_id", "text")
    assert texts.exceptAll(docs.select("doc_id", "text")).count() == 0 and texts.count() == len(kept)
    assert corpus_pipeline.run(spark, SF).columns == pieces.columns
