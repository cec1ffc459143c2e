"""Ranked lexical search by the Best Position Algorithm over impact lists.

The documents are indexed in segments, each one row of a stored table: for every
query term the documents that hold it and how often. A segment closes at
``SEGMENT_POSTINGS`` postings or ``SEGMENT_DOCS`` documents, so memory does not
grow with the input, and the index stays where its documents are: neither a word
that every document holds nor a source with a third of the rows moves data. Only
counts per query term are shuffled; they give each term's weight.

In a segment every term has an impact list, its documents by falling impact. A
query reads its lists side by side. Each document met is looked up in all of the
query's lists (direct access), which completes its score and marks its places
as seen. The best position of a list is the end of its gapless run of seen
places, often far behind the place read last; no unseen document scores more than
the sum of the impacts at the best positions. Reading stops once that sum is
strictly below the score of the k-th document, so ties are never cut. Lists are
read in rounds of doubling depth. The best of the segments are merged per item.

Queries go to the tasks in blocks of at most ``BLOCK_TERMS`` terms (one item at
least), one block on the driver at a time; every block is held against all
documents.

Scores are whole numbers, so results do not depend on order or partitioning. Equal
scores rank by document id, null ids first; rows that agree in both are ranked in
any order. A null or empty text has no terms, is not counted and never found; an
item without terms finds nothing. Repeated documents are documents of their own,
as in the counts; an item's repeated rows count once, and rows that share an id but
not the text are ranked as one list each. Very long texts are read whole. Extra
columns are ignored; an empty table on either side gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType

from kliping.llm.decontaminate import words
from kliping.llm.shared import map_slices, schema_of, stored

TOP = 50
SEGMENT_POSTINGS = 2_000_000
SEGMENT_DOCS = 50_000
BLOCK_TERMS = 500_000
DEPTH = 32  # places read in the first round


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Segment:
    """Impact lists of some documents: postings by term, in order of impact and in order of document."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_docs: int) -> None:
        by_doc = np.lexsort((doc, term))
        by_impact = np.lexsort((doc, -impact, term))
        self.terms, self.start, counts = np.unique(term[by_doc], return_index=True, return_counts=True)
        self.end = self.start + counts
        self.n_docs = n_docs
        self.doc, self.score = doc[by_doc], impact[by_doc]
        self.sorted_doc, self.sorted_impact = doc[by_impact], impact[by_impact]
        # Where the posting at each place of the document order stands in the impact order.
        rank = np.empty(len(term), np.int64)
        rank[by_impact] = np.arange(len(term))
        self.place = rank[by_doc]

    def best(self, query: np.ndarray, top: int, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents, scores and places read: a superset of the ``top`` best, ties included, all with full scores."""
        at = np.searchsorted(self.terms, query)
        at = at[(at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == query)] if len(self.terms) else at[:0]
        lists = [(int(self.start[k]), int(self.end[k])) for k in at]
        met = np.zeros(self.n_docs, bool)
        seen = [np.zeros(b - a + 1, bool) for a, b in lists]  # the last place stays unseen
        position = [0] * len(lists)
        docs, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        read = 0
        while lists:
            fresh = [self.sorted_doc[min(a + read, b) : min(a + read + depth, b)] for a, b in lists]
            read += depth
            depth *= 2
            new = np.unique(np.concatenate(fresh))
            new = new[~met[new]]
            met[new] = True
            total = np.zeros(len(new), np.int64)
            bound = 0
            for k, (a, b) in enumerate(lists):
                own = self.doc[a:b]
                spot = np.searchsorted(own, new)
                hit = np.flatnonzero(own[np.minimum(spot, b - a - 1)] == new)
                spot = spot[hit] + a
                total[hit] += self.score[spot]
                seen[k][self.place[spot] - a] = True
                position[k] += int(np.argmin(seen[k][position[k] :]))
                # Once all of a list is seen, other documents get nothing from it.
                if position[k] < b - a:
                    bound += int(self.sorted_impact[a + max(position[k], 1) - 1])
            docs.append(new)
            scores.append(total)
            done = np.concatenate(scores)
            if read >= max(b - a for a, b in lists) or (
                len(done) >= top and np.partition(done, len(done) - top)[len(done) - top] > bound
            ):
                return np.concatenate(docs), done, read
        return docs[0], scores[0], read


def _blocks(items: DataFrame, block_terms: int) -> Iterator[list[tuple[int, list[bytes]]]]:
    block, size = [], 0
    for number, text in items.select("item", "text").toLocalIterator():
        own = sorted(set(words(text)))
        if block and size + len(own) > block_terms:
            yield block
            block, size = [], 0
        if own:
            block.append((number, own))
            size += len(own)
    if block:
        yield block


def index(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """Segments of ``id``, ``text`` documents: ids, terms in each, how many documents have any, and the postings of ``terms``."""
    known = docs.sparkSession.sparkContext.broadcast(terms)
    schema = schema_of(
        ids=ArrayType(docs.schema["id"].dataType), lengths="array<long>", documents="long", total="long", term="array<int>",
        doc="array<int>", tf="array<int>", terms="array<int>", counts="array<long>",
    )
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, parts, size, documents, total = [], [], [], 0, 0, 0

        def segment() -> pa.RecordBatch:
            term, doc, tf = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int32) for k in range(3))
            found, counts = np.unique(term, return_counts=True)
            row = [ids, lengths, documents, total, term, doc, tf, found, counts]
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, out, strict=True)], schema=out)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = words(text.as_py())
                if not own:
                    continue
                documents += 1
                total += len(own)
                numbers = np.fromiter(map(known.value.get, own, repeat(-1)), np.int32, len(own))
                found, tf = np.unique(numbers[numbers >= 0], return_counts=True)
                if not len(found):
                    continue
                parts.append((found, np.full(len(found), len(ids), np.int32), tf.astype(np.int32)))
                ids.append(key)
                lengths.append(len(own))
                size += len(found)
                if size >= SEGMENT_POSTINGS or len(ids) >= SEGMENT_DOCS:
                    yield segment()
                    ids, lengths, parts, size, documents, total = [], [], [], 0, 0, 0
        if documents:
            yield segment()

    return stored(docs.select("id", "text").mapInArrow(run, schema), "impacts")


def _ranked(segments: DataFrame, block: list[tuple[int, list[bytes]]], terms: dict[bytes, int], top: int) -> DataFrame:
    """``item``, ``id`` and ``score`` of the best documents of every segment."""
    sums = segments.agg(F.sum("documents"), F.sum("total")).first()
    documents, total = (int(x or 0) for x in sums)
    each = segments.select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
    weights = np.zeros(len(terms), np.int64)
    for term, df in each.groupBy("x.terms").agg(F.sum("x.counts")).collect():  # one row per query term of the block
        weights[term] = weight(documents, df)
    queries = [(number, np.array(sorted(terms[w] for w in own), np.int64)) for number, own in block]
    shared = segments.sparkSession.sparkContext.broadcast((weights, queries))

    def find(columns: list[list]) -> list[list]:
        out: list[list] = [[], [], []]
        weights, queries = shared.value
        for ids, lengths, term, doc, tf in zip(*columns, strict=True):
            term, doc, tf = (np.array(x, np.int64) for x in (term, doc, tf))
            m = 50 + (50 * np.array(lengths, np.int64) * documents) // total
            impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
            held = impact > 0
            segment = Segment(term[held], doc[held], impact[held], len(ids))
            for number, query in queries:
                found, scores, _ = segment.best(query, top)
                if len(found) > top:
                    held = scores >= np.partition(scores, len(scores) - top)[len(scores) - top]
                    found, scores = found[held], scores[held]
                # Ties at the end of the list go by id.
                best = sorted(zip((-scores).tolist(), (_key(ids[d]) for d in found.tolist()), found.tolist(), strict=True))[:top]
                out[0] += [number] * len(best)
                out[1] += [ids[d] for _, _, d in best]
                out[2] += [-s for s, _, _ in best]
        return out

    schema = schema_of(item="long", id=segments.schema["ids"].dataType.elementType, score="long")
    return map_slices(segments.select("ids", "lengths", "term", "doc", "tf"), find, schema, size=1)


def _key(value: object) -> tuple:
    return (value is not None, value if value is not None else 0)


def search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", top: int = TOP, block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` (named by ``item_col`` and ``id_col``) of each item's best documents."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    queries = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).distinct()
    queries = stored(queries.withColumn("item", F.monotonically_increasing_id()), "queries")
    parts = []
    for block in _blocks(queries, block_terms):
        terms: dict[bytes, int] = {}
        for _, own in block:
            for w in own:
                terms.setdefault(w, len(terms))
        parts.append(_ranked(index(texts, terms), block, terms, top))
    names = [F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score"]
    if not parts:
        nothing = queries.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("score")).limit(0)
        return nothing.withColumn("id", F.lit(None).cast(docs.schema[id_col].dataType)).select(*names)
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc("id"))
    ranked = reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(queries.select("item", "item_id"), "item").select(*names)


def ranked_sql(top: int = TOP) -> str:
    """The query in SQL: every document scored for every item."""
    terms = (
        "unnest(regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[0-9a-z\x{{80}}-\x{{10FFFF}}]+'))"
    )
    return f"""
WITH words AS (SELECT doc_id, {terms.format(t="text")} AS term FROM documents),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY ALL),
stats AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tfs CROSS JOIN stats GROUP BY term, docs
),
queries AS (SELECT DISTINCT item_id, {terms.format(t="text")} AS term FROM benchmark),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))))::BIGINT AS score
  FROM queries JOIN tfs USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id) CROSS JOIN stats GROUP BY ALL
),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {top}"""
