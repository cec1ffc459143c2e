"""What the physical plans must and must not hold."""

import pytest

from pyspark.sql import functions as F

from kliping.functions import urls
from kliping.operators import links
from kliping.plans import articles
from kliping.queries import QUERIES, load_all
from kliping.rules.sites import site_rules
from kliping.session import shuffle_partitions, table

load_all()
SF = "/root/testdata/sf0.001"
PYTHON = {"extract_fields", "repair_author", "listing_items", "jsonld_pick"}


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loops_and_no_stray_python(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    has_python = any(node in text for node in ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas"))
    assert has_python == (name in PYTHON)


def test_columns_are_pruned(spark):
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan(spark, "canonical_url")
    assert "html" not in plan(spark, "new_links")
    assert "struct<ts:timestamp_ntz,event_type:string>" in plan(spark, "coverage")


def test_filters_are_pushed(spark):
    assert "EqualTo(source,src3), StringContains(text,the)], ReadSchema" in plan(spark, "scan_store")
    assert "StringStartsWith(url,http:)" in plan(spark, "new_links")
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00), LessThan(ts,2024-01-16T00:00)" in plan(spark, "filter_date")


@pytest.mark.parametrize("name", ["latest_n", "first_by_url", "article_table"])
def test_rank_limits_run_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert "WindowGroupLimit" in text[text.index("Exchange"):]


def test_stored_addresses_leave_before_python(spark):
    pages = table(spark, SF, "pages").select("page_id", urls.host(F.col("url")).alias("site"), "url", "html")
    known = pages.filter(F.col("url").startswith("http:")).select(links.canonical_url(F.col("url")).alias("url_key"))
    text = articles.fresh_fields(pages, site_rules(spark), known)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in text[text.index("MapInArrow"):]


def test_partitions_follow_the_input():
    assert shuffle_partitions(1) == 200
    assert shuffle_partitions(10 * 1024**4) == 81_920
    assert shuffle_partitions(100 * 1024**4) == 819_200


def test_banned_addresses_leave_before_python(spark):
    pages = table(spark, SF, "pages").select("page_id", urls.host(F.col("url")).alias("site"), "url", "html")
    from kliping.operators import extract

    text = extract.extract_fields(pages, site_rules(spark))._jdf.queryExecution().executedPlan().toString()
    below = text[text.index("MapInArrow"):]
    assert "arrays_overlap(split(url" in below and "_barred" in below


def test_a_driver_folder_is_no_shared_folder():
    from types import SimpleNamespace

    import pytest

    from kliping.session import shared_folder

    def session(master, **conf):
        unset = SimpleNamespace(get=lambda name, default=None: None)
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda name, default=None: conf.get(name.replace(".", "__"), default)),
            sparkContext=SimpleNamespace(master=master, getConf=lambda: unset),
        )

    own = {"spark__sql__warehouse__dir": "file:/work/spark-warehouse"}
    assert shared_folder(session("local[8]", **own)) == "file:/work/spark-warehouse/checkpoints"
    assert shared_folder(session("yarn", **own, spark__checkpoint__dir="hdfs://n/c/")) == "hdfs://n/c"
    assert shared_folder(session("yarn", spark__sql__warehouse__dir="hdfs://n/w")) == "hdfs://n/w/checkpoints"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn", **own))
