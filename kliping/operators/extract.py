"""Field extraction by rule rows.

A site is a row of rules, not a program: ``extract_fields`` joins pages with
the (literal, one row per site) rule table and evaluates the rules over the
node array of each page. No rows are grouped or shuffled, so a site that holds
most pages costs no more per page than any other.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kliping.functions import cleanup, dates, nodes as N
from kliping.functions.nodes import STEP, let

RULE = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("steps", T.ArrayType(STEP)),
        T.StructField("take", T.StringType()),
        T.StructField("block", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("pattern", T.StringType()),
        T.StructField("remove", T.StringType()),
        T.StructField("only", T.StringType()),
    ]
)
REQUIRED = T.StructType([T.StructField("name", T.StringType()), T.StructField("rule", RULE)])
BANNED = T.StructType([T.StructField("field", T.StringType()), T.StructField("words", T.ArrayType(T.StringType()))])
DROP = T.StructType(
    [
        T.StructField("step", STEP),
        T.StructField("mode", T.StringType()),
        T.StructField("phrase", T.StringType()),
        T.StructField("child", T.StringType()),
        T.StructField("also", T.ArrayType(T.StringType())),
        T.StructField("when", T.StringType()),
    ]
)
FIELDS = ["post_id", "author", "pubdate", "category", "subcategory", "comments", "images", "title", "tags"]
CHECKS = ["caption"]
SITE_RULES = T.StructType(
    [
        T.StructField("site", T.StringType()),
        T.StructField("source", T.StringType()),
        # One chain of rules per name of FIELDS + CHECKS, in that order.
        T.StructField("fields", T.ArrayType(T.ArrayType(RULE))),
        T.StructField("required", T.ArrayType(REQUIRED)),
        T.StructField("banned", T.ArrayType(BANNED)),
        T.StructField("body", T.ArrayType(RULE)),
        T.StructField("drops", T.ArrayType(DROP)),
        T.StructField("soft_drops", T.ArrayType(DROP)),
        T.StructField("cut", T.StringType()),
        T.StructField("escaped_twice", T.BooleanType()),
        T.StructField("escaped_json", T.BooleanType()),
    ]
)

# Text forms of a publishing date; no text fits two of them differently.
DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "dd/MM/yyyy", "yyyy-MM-dd"]

RuleKind = Callable[[Column, Column], Column]
_KINDS: dict[str, RuleKind] = {}


def register_rule_kind(name: str, value: RuleKind) -> None:
    """Add a rule kind: ``value(page, rule)`` gives a string Column.

    ``page`` offers ``page['nodes']``, their ``page['places']`` by tag, ``page['url']`` and ``page['blocks']``
    (JSON-LD texts); ``rule`` is one ``RULE`` struct. Sites with new needs are
    served by expressions like these instead of by code run per row.
    """
    _KINDS[name] = value


def _from_nodes(page: Column, rule: Column) -> Column:
    nodes = page["nodes"]
    found = N.select(nodes, N.root(nodes), rule["steps"], page["places"])
    return let(
        F.transform(found, lambda n: N.value_of(nodes, n, rule["take"], page["places"])),
        lambda values: F.when(F.size(values) > 0, F.array_join(values, ",")),
    )


def jsonld(blocks: Column, pick: Column | str) -> Column:
    """One JSON-LD text of a page: ``first``, ``second``, ``last``,
    ``before_last`` or ``dated`` (the last if it carries a date, else the first)."""
    pick = F.lit(pick) if isinstance(pick, str) else pick
    last = F.try_element_at(blocks, F.lit(-1))
    has_date = F.coalesce(F.get_json_object(last, "$.datePublished"), F.lit("")) != ""
    return (
        F.when(pick == "last", last)
        .when(pick == "second", F.get(blocks, 1))
        .when(pick == "before_last", F.try_element_at(blocks, F.lit(-2)))
        .when((pick == "dated") & has_date, last)
        .otherwise(F.get(blocks, 0))
    )


BODY_TEXT = r'(?s)"articleBody"\s*:\s*".*"\s*,\s*(?="datePublished")'


def repair_json(text: Column) -> Column:
    """Leave out a broken body text in front of the publishing date."""
    return F.when(F.try_parse_json(text).isNotNull(), text).otherwise(F.regexp_replace(text, BODY_TEXT, ""))


def plain_json(text: Column, escaped: Column) -> Column:
    """An escaped block resolved before it is parsed, without the body text, whose quotes would end it."""
    return F.when(escaped, cleanup.unescape_common(F.regexp_replace(text, BODY_TEXT, ""))).otherwise(text)


register_rule_kind("node", _from_nodes)
register_rule_kind(
    "jsonld", lambda page, rule: F.call_function("get_json_object", jsonld(page["blocks"], rule["block"]), rule["path"])
)
register_rule_kind("const", lambda page, rule: rule["path"])
register_rule_kind("url", lambda page, rule: page["url"])
register_rule_kind("link", lambda page, rule: F.when(rule["take"] == "category", page["link_category"]).otherwise(page["link_subcategory"]))


def rule_value(page: Column, rule: Column) -> Column:
    """Value of one rule, after its pattern (first group, NULL where it does
    not occur) and its removals."""
    raw = F.lit(None).cast("string")
    for name, value in _KINDS.items():
        raw = F.when(rule["kind"] == name, value(page, rule)).otherwise(raw)

    def group(value: Column) -> Column:
        part = F.get(F.regexp_extract_all(value, rule["pattern"], F.lit(1)), 0)
        return F.when(rule["pattern"].isNull(), value).otherwise(part)

    def clear(value: Column) -> Column:
        return F.replace(value, F.coalesce(rule["remove"], F.lit("")), F.lit(""))

    return let(let(raw, group), clear)


def first_value(page: Column, rules: Column) -> Column:
    """The first rule of a chain that finds something."""
    return F.get(F.filter(F.transform(rules, lambda r: rule_value(page, r)), lambda v: v.isNotNull()), 0)


def parse_pubdate(text: Column) -> Column:
    trimmed = cleanup.btrim_text(text)
    return F.coalesce(
        dates.iso_wallclock(trimmed),
        dates.parse_dates(F.substring(trimmed, 1, 19), DATE_FORMATS),
        F.when(trimmed.rlike(r"^\d{9,11}$"), dates.epoch_timestamp(trimmed)),
        dates.parse_local_dates(trimmed),
    )


def _drop_hits(nodes: Column, body: Column, author: Column, drop: Column, places: Column) -> Column:
    """Nodes below the body that one drop rule removes."""
    step, mode, phrase = drop["step"], drop["mode"], drop["phrase"]

    def first_below(node: Column, tag: Column | str) -> Column:
        return F.get(N.tagged(nodes, node, tag, places), 0)

    def says(node: Column) -> Column:
        return F.lower(N.text_of(nodes, node, places)).contains(phrase)

    in_child = drop["child"].isNotNull() & (mode != "self")

    def named(node: Column) -> Column:
        """Child, phrase and further tags are there as the rule wants them."""
        child = drop["child"].isNull() | let(
            first_below(node, drop["child"]),
            lambda c: c.isNotNull() & (phrase.isNull() | ~in_child | says(c)),
        )
        also = drop["also"].isNull() | F.forall(drop["also"], lambda t: first_below(node, t).isNotNull())
        return child & also & (phrase.isNull() | in_child | says(node))

    def byline(node: Column) -> Column:
        """Strong text that repeats the author, or an emphasised strong link."""
        linked = let(
            first_below(node, "em"),
            lambda em: let(first_below(em, "strong"), lambda s: first_below(s, "a").isNotNull()),
        )
        repeats = let(first_below(node, "strong"), lambda s: N.text_of(nodes, s, places) == author)
        emphasised = first_below(node, "em").isNotNull()
        return F.coalesce(F.when(emphasised, linked).otherwise(repeats), F.lit(False))

    def chosen(found: Column) -> Column:
        """The removed ones among the elements of the rule's step."""
        marker = F.get(found, 0)["i"]
        later = F.filter(N.inside(nodes, body), lambda n: (n["i"] > marker) & N.is_element(n))
        start = F.when(step["pick"] < 0, F.greatest(step["pick"], -F.size(found))).otherwise(1)
        return (
            F.when(F.size(found) == 0, found)
            .when(mode == "after", later)
            .when(mode == "byline", F.filter(found, byline))
            .otherwise(F.filter(F.slice(found, start, F.size(found)), named))
        )

    applies = drop["when"].isNull() | F.lower(N.string_of(nodes, body, places)).contains(drop["when"])
    hits = let(F.filter(N.tagged(nodes, body, step["tag"], places), lambda n: N.matches(n, step)), chosen)
    return F.when(applies, hits).otherwise(N.none_of(nodes))


def clean_body(nodes: Column, body: Column, author: Column, drops: Column, places: Column) -> Column:
    """Text of the body without what the drop rules remove."""
    dropped = F.flatten(F.transform(drops, lambda d: _drop_hits(nodes, body, author, d, places)))
    return N.joined_text(nodes, body, dropped)


def banned_words(values: Column, url: Column, banned: Column) -> Column:
    """``word_in_<field>`` for the first banned word group that occurs."""

    def hit(group: Column) -> Column:
        place = F.array_position(F.lit(FIELDS + CHECKS), group["field"]).cast("int")
        text = F.lower(F.get(values, place - 1))
        spoken = F.exists(group["words"], lambda w: F.coalesce(text.contains(w), F.lit(False)))
        segment = F.arrays_overlap(F.split(url, "/"), group["words"])
        return F.when(group["field"] == "segment", segment).otherwise(spoken)

    return F.concat(F.lit("word_in_"), F.get(F.filter(banned, hit), 0)["field"])


@lru_cache(maxsize=4)
def _expressions(application: str, kinds: tuple) -> dict[str, Column]:
    """The large expressions of ``extract_fields``, built once per session.

    They name columns only, so every call (and every batch of a stream) can
    use them again. ``kinds`` renews them when a rule kind is added.
    """
    page = F.col("page")
    nodes = page["nodes"]
    # Required parts are rules too, evaluated behind the fields.
    chains = F.concat("fields", F.transform("required", lambda r: F.array(r["rule"])))
    category = F.col("v")["category"]

    def applies(r: Column) -> Column:
        """A page without a category takes the body rules of all, in their order."""
        wanted = F.when(r["only"].startswith("!"), category != F.substr(r["only"], F.lit(2))).otherwise(category == r["only"])
        return F.coalesce(wanted, F.lit(True))

    body = F.transform(F.filter("body", applies), lambda r: N.select(nodes, N.root(nodes), r["steps"], page["places"]))

    def cleaned(done: Column, drops: Column) -> Column:
        """The softer cleaning is tried only where the strict one leaves nothing."""
        again = done.isNull() | ((done == "") & drops.isNotNull())
        return F.when(again, clean_body(nodes, F.col("b"), F.col("v")["author"], drops, page["places"])).otherwise(done)

    return {
        "values": F.transform(chains, lambda rules: first_value(page, rules)),
        "body": F.get(F.flatten(body), 0),
        "content": F.aggregate(F.array("drops", "soft_drops"), F.lit(None).cast("string"), cleaned),
    }


def extract_fields(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per page with the article fields and a ``reject_reason``.

    ``pages`` needs ``site, url, html`` and may carry ``category`` and
    ``subcategory`` from its listing link; further columns pass through.
    """
    have = set(pages.columns)
    carried = pages.withColumnsRenamed({c: f"link_{c}" for c in ("category", "subcategory") if c in have})
    for name in ("link_category", "link_subcategory"):
        if name not in carried.columns:
            carried = carried.withColumn(name, F.lit(None).cast("string"))
    extra = [c for c in carried.columns if c not in ("html", "link_category", "link_subcategory", "site", "url")]

    # The rule table has one literal row per site, so Spark broadcasts it by its
    # size. Pages of sites without rules stay, and so do those whose address is
    # banned, but their markup is not read.
    segments = F.flatten(F.transform(F.filter("banned", lambda b: b["field"] == "segment"), lambda b: b["words"]))
    known = rules.select("site", F.lit(True).alias("_ruled"), segments.alias("_segments"))
    barred = F.coalesce(F.arrays_overlap(F.split("url", "/"), "_segments"), F.lit(False))
    ruled = carried.join(known, "site", "left").withColumn("_barred", barred).drop("_segments")
    ruled = ruled.withColumn("html", F.when(F.col("_ruled") & ~F.col("_barred"), F.col("html")))
    joined = N.flatten_pages(ruled, places=True).join(rules, "site", "left")
    scripts = F.coalesce(F.try_element_at("places", F.lit("#json")), F.array().cast("array<int>"))
    # Some portals escape the whole block as if it were markup.
    blocks = F.transform(scripts, lambda k: repair_json(plain_json(F.get("nodes", k)["text"], F.col("escaped_json"))))
    page = F.struct("nodes", "places", "url", "link_category", "link_subcategory", blocks.alias("blocks"))
    staged = joined.withColumn("page", page).drop("nodes", "places")

    values, v = F.col("values"), F.col("v")
    names = FIELDS + CHECKS
    missing = F.transform(
        "required", lambda r, k: F.when(F.get(values, k + len(names)).isNull(), r["name"])
    )
    made = _expressions(pages.sparkSession.sparkContext.applicationId, tuple(_KINDS.items()))
    found = (
        staged.withColumn("values", made["values"])
        .withColumn("v", F.struct(*[F.get(values, k).alias(name) for k, name in enumerate(names)]))
        .withColumn("b", made["body"])
        .withColumn("content", made["content"])
    )
    cut = F.when(F.col("cut").isNull(), F.col("content")).otherwise(
        F.regexp_replace("content", F.concat(F.lit("(?s)"), F.col("cut"), F.lit(".*")), F.lit(""))
    )
    # A site that reads JSON-LD rejects a block that is none even after repair.
    reads = F.get(F.filter(F.flatten("fields"), lambda r: r["kind"] == "jsonld"), 0)
    block = jsonld(F.col("page")["blocks"], reads["block"])
    broken = reads.isNotNull() & block.isNotNull() & F.try_parse_json(block).isNull()
    reason = F.coalesce(
        F.when(F.col("_ruled").isNull(), F.lit("no_rules")),
        F.when(F.col("_barred"), F.lit("word_in_segment")),
        F.when(broken, F.lit("bad_jsonld")),
        F.get(F.array_compact(missing), 0),
        banned_words(values, F.col("url"), F.col("banned")),
        F.when(F.col("b").isNull(), F.lit("no_body")),
    )
    stamp = parse_pubdate(v["pubdate"])

    def text(value: Column) -> Column:
        value = F.coalesce(value, F.lit(""))
        return F.when(F.col("escaped_twice"), cleanup.unescape_common(value)).otherwise(value)

    return (
        found.withColumn("content", cleanup.strip_control(cleanup.normalized(F.col("content"))))
        .select(
            *extra,
            "site",
            dates.article_key([v["post_id"]], stamp, F.col("url")).alias("post_id"),
            text(v["author"]).alias("author"),
            stamp.alias("pubdate"),
            text(v["category"]).alias("category"),
            text(v["subcategory"]).alias("subcategory"),
            text(cut).alias("content"),
            dates.comment_count(v["comments"]).alias("comments"),
            F.coalesce(v["images"], F.lit("")).alias("images"),
            text(v["title"]).alias("title"),
            text(v["tags"]).alias("tags"),
            "url",
            "source",
            reason.alias("reject_reason"),
        )
    )
