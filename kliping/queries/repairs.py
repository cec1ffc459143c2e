"""Repair of stored rows."""

from pyspark.sql import functions as F

from kliping.functions import cleanup, dates, urls
from kliping.operators import dedupe, repair
from kliping.queries import sqltext as q
from kliping.queries.fields import FIELDS_SQL, PLAIN_SITE, plain_pages
from kliping.queries.registry import query
from kliping.rules.sites import site_rules
from kliping.schema import ARTICLE
from kliping.session import scratch_path, table
from kliping.sources import store


@query("""
    SELECT doc_id, source, lang FROM documents
    WHERE (text LIKE '%the%' AND text LIKE '%of%') OR text = '' OR source IN ('src1', 'src2')
""")
def repair_candidates(spark, sf):
    documents = table(spark, sf, "documents")
    text = F.col("text")
    wanted = (text.contains("the") & text.contains("of")) | (text == "") | F.col("source").isin("src1", "src2")
    return repair.candidates(documents, wanted, ["doc_id", "source", "lang"])


@query(r"""
    SELECT doc_id, lang, source,
           CASE WHEN contains(text, 'the') THEN regexp_replace(text, '[\n\t\r]', '', 'g') ELSE text END AS text
    FROM documents
""")
def repair_merge(spark, sf):
    """Documents as articles of a store, partitioned by source; stored line feeds are cleaned away where a candidate has them."""
    documents = table(spark, sf, "documents").select(
        F.col("doc_id").alias("post_id"), F.col("text").alias("content"), F.col("lang").alias("category"), "source",
        F.concat(F.lit("http://doc/"), F.col("doc_id")).alias("url"),
    )
    blank = {f.name: F.lit(None).cast(f.dataType) for f in ARTICLE.fields if f.name not in documents.columns}
    path = scratch_path(spark, "store")
    store.append(store.with_keys(documents.withColumns(blank)).select(*store.STORED.fieldNames()), path)
    stored = store.read_store(spark, path)
    fixes = repair.candidates(stored, F.col("content").contains("the"), ["url_key", "content"]).withColumn(
        "content", cleanup.strip_control(F.col("content"))
    )
    store.repair_partitions(stored, fixes, path, ["content"])
    return store.read_store(spark, path).select(
        F.col("post_id").alias("doc_id"), F.col("content").alias("text"), F.col("category").alias("lang"), "source"
    )


@query("""
    WITH stored AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '1970-01-01 01:01:01'
                           ELSE o_orderdate END AS pubdate FROM orders),
    known AS (SELECT o_custkey, max(pubdate) AS latest FROM stored WHERE pubdate <> TIMESTAMP '1970-01-01 01:01:01' GROUP BY o_custkey)
    SELECT o_orderkey, CASE WHEN pubdate = TIMESTAMP '1970-01-01 01:01:01' THEN coalesce(latest, pubdate) ELSE pubdate END AS pubdate
    FROM stored s LEFT JOIN known k ON k.o_custkey = s.o_custkey
""")
def repair_pubdate(spark, sf):
    """Rows with the sentinel get the latest known date of their customer."""
    found = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    stored = table(spark, sf, "orders").select("o_orderkey", "o_custkey", dates.with_sentinel(found).alias("pubdate"))
    missing = repair.candidates(stored, dates.without_sentinel(F.col("pubdate")).isNull(), ["o_orderkey", "o_custkey"])
    known = stored.groupBy("o_custkey").agg(F.max(dates.without_sentinel(F.col("pubdate"))).alias("pubdate"))
    fixes = missing.join(known, "o_custkey").select("o_orderkey", "pubdate")
    return repair.merge(stored, fixes, "o_orderkey", ["pubdate"]).select("o_orderkey", "pubdate")


@query(f"""
    WITH stored AS (SELECT page_id, {q.KEY} AS url_key, CASE WHEN url LIKE 'http:%' THEN '' ELSE 'kept' END AS author FROM pages),
    once AS (SELECT {q.KEY} AS url_key, author, reject_reason FROM ({FIELDS_SQL})
             QUALIFY row_number() OVER (PARTITION BY {q.KEY} ORDER BY page_id) = 1),
    again AS (SELECT * FROM once WHERE reject_reason IS NULL)
    SELECT page_id, s.url_key, CASE WHEN s.author = '' THEN coalesce(a.author, '') ELSE s.author END AS author
    FROM stored s LEFT JOIN again a ON a.url_key = s.url_key
""")
def repair_author(spark, sf):
    """Stored rows without an author get the one their page names."""
    key = urls.canonical(F.col("url")).alias("url_key")
    author = F.when(F.col("url").startswith("http:"), "").otherwise("kept").alias("author")
    stored = table(spark, sf, "pages").select("page_id", key, author)
    wanted = repair.candidates(stored, F.col("author") == "", ["url_key"])
    once = dedupe.first_by_key(plain_pages(spark, sf).withColumn("url_key", key), "url_key", ["page_id"])
    fixes = repair.recompute(wanted, once.drop("url_key"), site_rules(spark, PLAIN_SITE), ["author"])
    empty = repair.merge(stored.filter(F.col("author") == ""), fixes, "url_key", ["author"])
    return empty.unionByName(stored.filter(F.col("author") != "")).select("page_id", "url_key", "author")
