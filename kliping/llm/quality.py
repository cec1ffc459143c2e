"""Quality rules: lines that many documents of a host share, and counts over words.

Lines are normalised (lower case, digits to one zero, white space to single
spaces, ends trimmed) and hashed; a line without letters or digits does not
count. For each host the distinct documents of each line are counted over the
whole table. A line is boilerplate where more than ``SHARE`` of the host's
documents and at least ``LEAST`` of them have it. Boilerplate lines are taken
out, and a document is depleted if fewer than ``REST`` of its words are left.

Base rules, over words split by blanks, tabs and line ends: fewer than 50 words
fail, and so do texts where more than half of the words stand in three-word
windows found twice or more.

A null text has no words; a null host is a host of its own; a document's lines
count once however often it repeats them, and so do those of rows that share an id
in a host, with one text or several; rows without an id are documents of their own. Very long texts are read whole.
Ties need no rule, since nothing is ranked. Extra columns are ignored; an empty table gives no rows. A hot line
is counted by partial sums, and at most 1 / ``SHARE`` times the mean number of
lines in a document can be boilerplate in a host, so the set that the second
pass joins is small; it is stored first, so that Spark knows its size and picks
the join. Texts are read once; what is shuffled are line hashes.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kliping.llm.shared import map_slices, schema_of, stored

SHARE = 0.02
LEAST = 20
REST = 0.5

WORD = re.compile(r"[^ \t-\r]+")
MARK = re.compile(r"[#*$%&|<>]")
NUMBER = re.compile(r"[0-9]+")
CONTENT = re.compile(r"\w")
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def line_hash(line: str) -> int | None:
    """Signed 64-bit hash of the normalised line, None for a line without content."""
    if not CONTENT.search(line):
        return None
    plain = " ".join(WORD.findall(NUMBER.sub("0", line.lower())))
    return xxhash.xxh64_intdigest(plain) - (1 << 63)


def repeated_words(words: list[str]) -> int:
    """Words inside three-word windows that occur twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
    triples = pairs[:-1] * np.int64(len(numbers)) + ids[2:]
    _, which, counts = np.unique(triples, return_inverse=True, return_counts=True)
    twice = counts[which] > 1
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[k : n - 2 + k] |= twice
    return int(hit.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, lines equal to an earlier one, repeated words."""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(MARK.findall(text)), len(lines) - len(set(lines)), repeated_words(words)
    )


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One stored row per document: its number, id, host, digest, base counts, distinct line hashes and words per hash."""

    def rows(columns: list[list]) -> list[list]:
        ids, hosts, digests, texts = columns
        out: list[list] = [ids, hosts, digests, *([] for _ in range(7))]
        for text in texts:
            lines: dict[int, int] = {}
            for line in text.split("\n"):
                if (h := line_hash(line)) is not None:
                    lines[h] = lines.get(h, 0) + len(WORD.findall(line))
            for place, value in zip(out[3:], (*base_counts(text), list(lines), list(lines.values())), strict=True):
                place.append(value)
        return out

    schema = schema_of(
        id=docs.schema[id_col].dataType, host="string", digest="long", **dict.fromkeys(COUNTS, "long"),
        lines="array<long>", line_words="array<int>",
    )
    texts = docs.select(
        F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"),
        F.xxhash64(text_col).alias("digest"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return stored(map_slices(texts, rows, schema).withColumn("row", F.monotonically_increasing_id()), "line-hashes")


def hot_lines(rows: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """``host`` and ``line``, the hashes of its boilerplate, with the number of documents that have each."""
    # Few ids are repeated, if any, so only their lines are told apart by id before they are counted.
    repeated = rows.filter("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id")
    once, often = rows.join(repeated, "id", "left_anti"), rows.join(repeated, "id", "left_semi")
    of_once = once.select("host", F.explode("lines").alias("line"))
    of_often = often.select("host", "id", F.explode("lines").alias("line")).distinct().select("host", "line")
    counted = of_once.unionByName(of_often).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    documents = once.select("host").unionByName(often.select("host", "id").distinct().select("host"))
    sizes = documents.groupBy(F.col("host").alias("of")).agg(F.count(F.lit(1)).alias("docs"))
    over = counted.join(sizes, counted.host.eqNullSafe(F.col("of"))).filter(F.col("n") > share * F.col("docs"))
    return stored(over.select("host", "line", "n"), "hot-lines")


def _hits(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """``row``, ``line`` and ``words`` of every boilerplate line of every document."""
    lines = rows.select("row", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("x")).select(
        "row", "host", F.col("x.lines").alias("line"), F.col("x.line_words").alias("words")
    )
    hot = hot.select(F.col("host").alias("of"), F.col("line").alias("hot"))
    return lines.join(hot, lines.host.eqNullSafe(hot["of"]) & (F.col("line") == F.col("hot"))).select(
        "row", "line", "words"
    )


def judged(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", share: float = SHARE,
    least: int = LEAST, rest: float = REST,
) -> DataFrame:
    """One row per document: id, base counts, words left without boilerplate, and the verdicts."""
    rows = measured(docs, id_col, text_col, host_col)
    lost = _hits(rows, hot_lines(rows, share, least)).groupBy("row").agg(F.sum("words").alias("lost"))
    counts = rows.select("row", "id", *COUNTS).join(lost, "row", "left")
    counts = counts.withColumn("n_left", F.col("n_words") - F.coalesce(F.col("lost"), F.lit(0)))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = F.col("n_left") < rest * F.col("n_words")
    return counts.select(
        "id", *COUNTS, "n_left", failed.alias("base_failed"), depleted.alias("depleted"),
        (~failed & ~depleted).alias("kept"),
    )


def without_boilerplate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", share: float = SHARE,
    least: int = LEAST,
) -> DataFrame:
    """The documents, same columns, with the boilerplate lines taken out of their texts."""
    rows = measured(docs, id_col, text_col, host_col)
    own = _hits(rows, hot_lines(rows, share, least)).groupBy("row").agg(F.collect_list("line").alias("_lines"))
    known = rows.join(own, "row").select(F.col("host").alias("_host"), F.col("digest").alias("_digest"), "_lines")
    known = known.dropDuplicates(["_host", "_digest"])
    both = docs.join(
        known,
        docs[host_col].cast("string").eqNullSafe(F.col("_host")) & (F.xxhash64(docs[text_col]) == F.col("_digest")),
        "left",
    ).drop("_host", "_digest")
    at = docs.columns.index(text_col)

    def rest(columns: list[list]) -> list[list]:
        for i, (text, lines) in enumerate(zip(columns[at], columns[-1], strict=True)):
            if lines:
                gone = set(lines)
                columns[at][i] = "\n".join(x for x in text.split("\n") if line_hash(x) not in gone)
        return columns[:-1]

    return map_slices(both, rest, docs.schema)
