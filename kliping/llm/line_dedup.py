"""Line dedup over windows of lines: later repeats of runs of lines are deleted.

Lines are cut at line feeds and compared without blanks, tabs and carriage
returns at their ends; lines that are empty then do not count and are never
deleted by themselves. A run is ``RUN`` lines or more that stand one behind
another, apart from empty ones. Each window of ``RUN`` lines marks the line
with the smallest hash, the last of equal ones, as its fingerprint, so two equal
runs have a fingerprint in common at the same place. Fingerprints that occur at
one position only are dropped; the positions of the others are joined with the
first position of their window, the hashes of all its lines. So winnowing does
not select here: every window is kept and grouped as a whole, the fingerprint
only filters beforehand, and no match is grown line by line. The first place of
a fingerprint need not be that of the window, which the rule asks for. A window that stands earlier too, by id, then by
position, is a repeat, and its lines go; overlapping windows make longer runs.
The first occurrence of a line's text within repeated runs always stays.

With ``words`` given, a run of fewer lines counts too if it holds that many
words, cut at blanks: windows of one line up to ``RUN`` - 1 lines join those of
``RUN``. Lines can be whole paragraphs, so a passage of one or two of them may be
long. Without it, the rule is that of ``deduplicated_sql``.

Everything is DataFrame functions. Windows are counted by partial aggregates,
so a run that a third of the documents share is no hot group, and its join key
is one that Spark splits. What is shuffled are hashes; texts move only once, to
meet the numbers of their lost lines.

A null text has no lines and stays null. Null ids come first. Repeated rows of
one id and text are one place: none is earlier than the other. Extra columns
are kept, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kliping.llm.shared import stored

RUN = 3
WORDS = 25  # for ``words``, where short runs are to go too: half a passage of 50
BLANK = " \t\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _starts(run: int, words: int) -> Column:
    """Structs of ``at`` and ``k``, of all windows: ``run`` lines, or fewer that hold ``words`` words together."""

    def of(k: int) -> Column:
        at = F.sequence(F.lit(0), F.size("h") - k)
        if k < run:
            at = F.filter(at, lambda a: F.aggregate(F.slice("w", a + 1, F.lit(k)), F.lit(0), lambda x, y: x + y) >= words)
        each = F.transform(at, lambda a: F.struct(a.alias("at"), F.lit(k).alias("k")))
        return F.when(F.size("h") >= k, each).otherwise(F.array().cast("array<struct<at:int,k:int>>"))

    return F.concat(*map(of, range(1, run + 1)))


def _windows(docs: DataFrame, run: int, words: int | None = None) -> DataFrame:
    """``id``, ``digest``, ``at`` and the line hashes of each window, with its fingerprint ``mark`` and that one's place.

    ``lines`` are the numbers of the window's lines in the text.
    """
    if words is not None:
        return _windows_by_words(docs, run, words)
    trimmed = F.transform(_lines(F.col("text")), lambda x: F.trim(x, F.lit(BLANK)))
    hashed = F.transform(trimmed, lambda x, i: F.struct(F.xxhash64(x).alias("h"), i.alias("n"), (x != "").alias("full")))
    full = docs.select("id", "digest", F.filter(hashed, lambda x: x["full"]).alias("l")).filter(F.size("l") >= run)
    full = full.select("id", "digest", F.col("l.h").alias("h"), F.col("l.n").alias("n"))
    starts = F.sequence(F.lit(0), F.size("h") - run)
    each = full.select("id", "digest", "h", "n", F.explode(starts).alias("at"))
    window = F.slice("h", F.col("at") + 1, F.lit(run))
    each = each.select("id", "digest", "at", window.alias("window"), F.slice("n", F.col("at") + 1, F.lit(run)).alias("lines"))
    mark = F.array_min("window")
    return each.select("*", mark.alias("mark"), (F.lit(run) - F.array_position(F.reverse("window"), mark)).cast("int").alias("place"))


def _windows_by_words(docs: DataFrame, run: int, words: int) -> DataFrame:
    """The same with the shorter windows that hold ``words`` words."""
    trimmed = F.transform(_lines(F.col("text")), lambda x: F.trim(x, F.lit(BLANK)))
    hashed = F.transform(trimmed, lambda x, i: F.struct(
        F.xxhash64(x).alias("h"), i.alias("n"), (x != "").alias("full"), F.size(F.split(x, f"[{BLANK}]+")).alias("w")
    ))
    full = docs.select("id", "digest", F.filter(hashed, lambda x: x["full"]).alias("l")).filter(F.size("l") > 0)
    full = full.select("id", "digest", F.col("l.h").alias("h"), F.col("l.n").alias("n"), F.col("l.w").alias("w"))
    each = full.select("id", "digest", "h", "n", F.explode(_starts(run, words)).alias("x"))
    each = each.select("id", "digest", F.col("x.at").alias("at"), F.col("x.k").alias("k"), "h", "n")
    window, lines = (F.slice(c, F.col("at") + 1, F.col("k")) for c in ("h", "n"))
    each = each.select("id", "digest", "at", "k", window.alias("window"), lines.alias("lines"))
    mark = F.array_min("window")
    place = (F.col("k") - F.array_position(F.reverse("window"), mark)).cast("int")
    return each.select("id", "digest", "at", "window", "lines", mark.alias("mark"), place.alias("place"))


def deleted_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN, words: int | None = None
) -> DataFrame:
    """``id``, ``digest`` and the sorted numbers of the ``lines`` that go, for texts that lose any."""
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text"))
    windows = stored(_windows(texts, run, words), "line-windows")
    where = F.struct("id", "digest", (F.col("at") + F.col("place")).alias("at"))
    marks = windows.groupBy("mark").agg(F.min(where).alias("first"), F.max(where).alias("last"))
    common = marks.filter("first <> last").select("mark")
    # The match around a fingerprint: the window itself, held against its first occurrence.
    near = windows.join(common, "mark")
    start = F.struct("id", "digest", "at")
    first = near.groupBy("mark", "place", "window").agg(F.min(start).alias("first"), F.max(start).alias("last"))
    first = first.filter("first <> last").select("mark", "place", "window", "first")
    later = near.join(first, ["mark", "place", "window"]).filter(start > F.col("first"))
    gone = later.select("id", "digest", F.explode("lines").alias("line"))
    return gone.groupBy("id", "digest").agg(F.sort_array(F.collect_set("line")).alias("lines"))


def marked(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN, words: int | None = None
) -> tuple[DataFrame, Column]:
    """The documents, and a Column over them: the numbers of the lines that go, empty where none does."""
    gone = deleted_lines(docs, id_col, text_col, run, words)
    lost, id_, digest = (f"_{name}_of_line_dedup" for name in ("lines", "id", "digest"))
    gone = gone.select(F.col("id").alias(id_), F.col("digest").alias(digest), F.col("lines").alias(lost))
    same = docs[id_col].eqNullSafe(F.col(id_)) & (F.xxhash64(docs[text_col]) == F.col(digest))
    return docs.join(gone, same, "left").drop(id_, digest), F.coalesce(lost, F.array().cast("array<int>"))


def kept_text(text: Column, lost: Column) -> Column:
    """The text without the lost lines."""
    kept = F.filter(_lines(text), lambda _, i: ~F.array_contains(lost, i))
    return F.when(F.size(lost) == 0, text).otherwise(F.array_join(kept, "\n"))


def depleted(text: Column, lost: Column) -> Column:
    """Whether lines went and none with content is left."""
    return (F.size(lost) > 0) & (F.trim(F.translate(kept_text(text, lost), "\n\t\r", "   ")) == "")


def deduplicated_sql(run: int = RUN, table: str = "documents") -> str:
    """DuckDB SQL for ``doc_id``, ``n_lines``, ``n_deleted`` and ``kept_sha256``, over a table of unique ids."""
    window = ", ".join(f"lead(line, {k}) OVER w" for k in range(run))
    return f"""
WITH cut AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM {table} WHERE text IS NOT NULL),
     each AS (SELECT doc_id, unnest(ls) AS raw, unnest(range(len(ls))) AS n FROM cut),
     lines AS (SELECT doc_id, n, trim(raw, ' ' || chr(9) || chr(13)) AS line FROM each),
     runs AS (SELECT doc_id, n, row_number() OVER w AS pos, [{window}] AS win, lead(n, {run - 1}) OVER w AS stop
              FROM lines WHERE line <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS seen FROM runs WHERE stop IS NOT NULL),
     gone AS (SELECT DISTINCT l.doc_id, l.n FROM ranked r JOIN lines l
              ON l.doc_id = r.doc_id AND l.n BETWEEN r.n AND r.stop AND l.line <> '' WHERE r.seen > 1),
     kept AS (SELECT e.doc_id, count(*) AS n_lines, count(g.n) AS n_deleted,
                     string_agg(e.raw, chr(10) ORDER BY e.n) FILTER (WHERE g.n IS NULL) AS text
              FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.n = e.n GROUP BY e.doc_id)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_deleted, 0) AS n_deleted,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM {table} d LEFT JOIN kept k USING (doc_id)"""
