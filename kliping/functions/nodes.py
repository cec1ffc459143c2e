"""Pages as arrays of nodes, and selections over them as Column expressions.

``flatten_pages`` is the only Python step: a tolerant tokenizer that turns the
markup of each page into one array of nodes in document order. Everything else
-- choosing elements, reading values, leaving out parts, joining text -- works
on that array with higher-order functions inside the JVM.

A node has its place ``i``, the place ``last`` where its subtree ends, the place
``up`` of its parent, and ``tag``, ``attrs`` and ``text``. Tags: an element name;
``/name`` for its end; ``#text``; ``#comment``; ``#raw`` (script and style text);
``#json`` (JSON-LD text); node 0 is ``#root``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kliping.functions import cleanup

NODE = T.StructType(
    [
        T.StructField("i", T.IntegerType()),
        T.StructField("last", T.IntegerType()),
        T.StructField("up", T.IntegerType()),
        T.StructField("tag", T.StringType()),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("text", T.StringType()),
    ]
)
STEP = T.StructType(
    [
        T.StructField("axis", T.StringType()),
        T.StructField("tag", T.StringType()),
        T.StructField("attr", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("pick", T.IntegerType()),
    ]
)

PAGES_AT_ONCE = 100  # bounds the nodes a task holds, whatever the batch size

# --- fixed values (HTML element groups) --------------------------------------
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section summary table ul".split()
)
SCOPE = set("body button caption html object table td template th".split())
SPECIAL = BLOCK | SCOPE | set("head iframe noscript script select style tbody tfoot thead title tr".split())
TABLE = set("caption table tbody td tfoot th thead tr".split())
# An opening tag ends the open elements of the first set, if found before one of the second.
ENDS = {
    "li": ({"li"}, {"ul", "ol"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
}
# -----------------------------------------------------------------------------


class _Tokens(HTMLParser):
    """Collects the nodes of one page after the other in flat lists."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.last: list[int] = []
        self.up: list[int] = []
        self.tag: list[str] = []
        self.attrs: list[dict[str, str]] = []
        self.text: list[str | None] = []
        self.starts = [0]
        self.open: list[int] = []

    def page(self, markup: str | None) -> None:
        self.reset()
        self.open = []
        self._add("#root", opens=True)
        self.feed(markup or "")
        self.close()
        while self.open:
            self._end_top()
        self.starts.append(len(self.tag))

    def _add(self, tag: str, attrs: dict[str, str] | None = None, text: str | None = None, opens: bool = False) -> None:
        base = self.starts[-1]
        at = len(self.tag) - base
        self.last.append(at)
        self.up.append(self.open[-1] if self.open else -1)
        self.tag.append(tag)
        self.attrs.append(attrs or {})
        self.text.append(text)
        if opens:
            self.open.append(at)

    def _name(self, at: int) -> str:
        return self.tag[self.starts[-1] + at]

    def _end_top(self) -> None:
        base = self.starts[-1]
        at = self.open.pop()
        if at:
            self._add("/" + self._name(at))
        self.last[base + at] = len(self.tag) - base - 1

    def _end(self, names: set[str], barrier: set[str]) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            name = self._name(self.open[depth])
            if name in names:
                while len(self.open) > depth:
                    self._end_top()
                return
            if name in barrier:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS:
            self._end(*ENDS[tag])
        if tag in BLOCK:
            self._end({"p"}, SCOPE)
        named: dict[str, str] = {}
        for name, value in attrs:
            named.setdefault(name, " ".join((value or "").split()) if name == "class" else value or "")
        self._add(tag, named, opens=tag not in VOID)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self._add("br")
        elif tag not in VOID:
            barrier = {"table"} if tag in TABLE else SCOPE if tag in SPECIAL else SPECIAL
            self._end({tag}, barrier - {tag})

    def handle_data(self, data: str) -> None:
        holder = self.starts[-1] + self.open[-1]
        if self.tag[holder] == "script" and self.attrs[holder].get("type") == "application/ld+json":
            plain = unicodedata.normalize("NFKD", data)
            self._add("#json", text=plain.translate({9: None, 10: None, 13: None}))
        elif self.tag[holder] in ("script", "style"):
            self._add("#raw", text=data)
        elif self.tag[-1] == "#text" and len(self.tag) > self.starts[-1]:
            self.text[-1] += data
        else:
            self._add("#text", text=data)

    def handle_comment(self, data: str) -> None:
        self._add("#comment")

    def arrow(self) -> pa.Array:
        pairs = [(k, v) for attrs in self.attrs for k, v in attrs.items()]
        bounds = [0]
        for attrs in self.attrs:
            bounds.append(bounds[-1] + len(attrs))
        places = [n for a, b in zip(self.starts, self.starts[1:]) for n in range(b - a)]
        maps = pa.MapArray.from_arrays(
            pa.array(bounds, pa.int32()), pa.array([k for k, _ in pairs], pa.string()), pa.array([v for _, v in pairs], pa.string())
        )
        fields = [
            pa.array(places, pa.int32()), pa.array(self.last, pa.int32()), pa.array(self.up, pa.int32()),
            pa.array(self.tag, pa.string()), maps, pa.array(self.text, pa.string()),
        ]
        return pa.ListArray.from_arrays(
            pa.array(self.starts, pa.int32()), pa.StructArray.from_arrays(fields, names=NODE.fieldNames())
        )


PLACES = T.MapType(T.StringType(), T.ArrayType(T.IntegerType()))


def _places(tokens: _Tokens) -> pa.Array:
    """Per page a map from each tag to the places of its nodes, in document order; ends of elements are left out."""
    keys: list[str] = []
    bounds, ends, flat = [0], [0], []
    for a, b in zip(tokens.starts, tokens.starts[1:]):
        of: dict[str, list[int]] = {}
        for place, tag in enumerate(tokens.tag[a:b]):
            if tag[0] != "/":
                of.setdefault(tag, []).append(place)
        for tag, places in of.items():
            keys.append(tag)
            flat += places
            ends.append(len(flat))
        bounds.append(len(keys))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
    return pa.MapArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(keys, pa.string()), lists)


def flatten_pages(pages: DataFrame, html: str = "html", places: bool = False) -> DataFrame:
    """Replace the markup column by ``nodes``; other columns pass through.

    With ``places`` also by an index, tag to places, for selections that read their own places instead of all nodes.

    Select before the call what is needed after it: columns are not pruned
    through a Python step.
    """
    at = pages.columns.index(html)
    kept = [f for f in pages.schema.fields if f.name != html]
    added = [T.StructField("nodes", T.ArrayType(NODE)), *([T.StructField("places", PLACES)] if places else [])]
    schema = T.StructType([*kept, *added])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(first, PAGES_AT_ONCE)
                tokens = _Tokens()
                for markup in part.column(at).to_pylist():
                    tokens.page(markup)
                columns = [c for k, c in enumerate(part.columns) if k != at]
                names = [n for k, n in enumerate(part.schema.names) if k != at]
                made = [tokens.arrow(), *([_places(tokens)] if places else [])]
                yield pa.RecordBatch.from_arrays([*columns, *made], names=[*names, *(f.name for f in added)])

    return pages.mapInArrow(run, schema)


# -- selections ------------------------------------------------------------------


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Use a value several times but compute it once."""
    return F.get(F.transform(F.array(value), use), 0)


def root(nodes: Column) -> Column:
    """The starting point of selections over a whole page."""
    return F.array(F.get(nodes, 0))


def none_of(nodes: Column) -> Column:
    """An empty array of nodes."""
    return F.filter(root(nodes), lambda n: F.lit(False))


def between(nodes: Column, first: Column, last: Column) -> Column:
    """Nodes by place, reading only those asked for."""
    places = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda k: F.get(nodes, k))


def inside(nodes: Column, node: Column) -> Column:
    """The nodes below a node; their places follow each other."""
    return F.when(node["i"] == 0, nodes).otherwise(between(nodes, node["i"] + 1, node["last"]))


def tagged(nodes: Column, node: Column, tag: Column | str, places: Column | None = None) -> Column:
    """Nodes of one tag below a node, from the index if there is one."""
    if places is None:
        return F.filter(inside(nodes, node), lambda n: n["tag"] == tag)
    own = F.coalesce(F.try_element_at(places, F.lit(tag) if isinstance(tag, str) else tag), F.array().cast("array<int>"))
    below = F.filter(own, lambda k: (k > node["i"]) & (k <= node["last"]))
    return F.transform(below, lambda k: F.get(nodes, k))


def matches(node: Column, step: Column) -> Column:
    """Tag and attribute test. One class word matches any of the element's
    words, several match the whole attribute in that order."""
    value = F.try_element_at(node["attrs"], step["attr"])
    listed = step["attr"].isin("class", "rel")
    return (node["tag"] == step["tag"]) & (
        step["attr"].isNull()
        | (
            value.isNotNull()
            & (
                step["value"].isNull()
                | (value == step["value"])
                | (listed & F.array_contains(F.split(value, " "), step["value"]))
            )
        )
    )


def select(nodes: Column, start: Column, steps: Column, places: Column | None = None) -> Column:
    """Follow steps from an array of nodes; each narrows to all matches below
    (axis ``in``) or to following siblings (axis ``next``), in document order.

    ``pick`` 0 keeps all, n the n-th and -n the n-th from the end; one that is
    out of range leaves nothing.
    """

    def follow(found: Column, step: Column) -> Column:
        def below(node: Column) -> Column:
            return F.filter(tagged(nodes, node, step["tag"], places), lambda n: matches(n, step))

        def beside(node: Column) -> Column:
            end = F.get(nodes, node["up"])["last"]
            rest = between(nodes, node["last"] + 1, end)
            return F.filter(rest, lambda n: (n["up"] == node["up"]) & is_element(n) & ((step["tag"] == "*") | matches(n, step)))

        hits = F.flatten(F.transform(found, lambda n: F.when(step["axis"] == "next", beside(n)).otherwise(below(n))))
        every = step["pick"] == 0
        return F.slice(hits, F.when(every, 1).otherwise(step["pick"]), F.when(every, F.size(nodes)).otherwise(1))

    return F.aggregate(steps, start, follow)


def is_element(node: Column) -> Column:
    return ~node["tag"].startswith("#") & ~node["tag"].startswith("/")


def text_of(nodes: Column, node: Column, places: Column | None = None) -> Column:
    """Text below a node: every part stripped, joined with nothing."""
    parts = tagged(nodes, node, "#text", places)
    return F.array_join(F.transform(parts, lambda n: cleanup.strip_text(n["text"])), "")


def string_of(nodes: Column, node: Column, places: Column | None = None) -> Column:
    """Text below a node as it stands."""
    parts = tagged(nodes, node, "#text", places)
    return F.array_join(F.transform(parts, lambda n: n["text"]), "")


def value_of(nodes: Column, node: Column, take: Column, places: Column | None = None) -> Column:
    """``text``, ``string`` (unstripped) or the named attribute of a node."""
    return (
        F.when(take == "text", text_of(nodes, node, places))
        .when(take == "string", string_of(nodes, node, places))
        .otherwise(F.try_element_at(node["attrs"], take))
    )


def joined_text(nodes: Column, top: Column, dropped: Column) -> Column:
    """Text below ``top`` without the dropped subtrees.

    Line breaks become spaces and other tags separate texts, which are stripped
    and joined with nothing. ``dropped`` is an array of nodes; the gaps between their
    ranges come out of one sweep over them in order.
    """
    ranges = F.array_sort(F.transform(dropped, lambda d: F.struct(d["i"].alias("a"), d["last"].alias("b"))))
    none = F.array().cast("array<struct<a:int,b:int>>")
    begin = F.struct(top["i"].alias("at"), none.alias("gaps"))

    def sweep(done: Column, r: Column) -> Column:
        gap = F.array(F.struct(done["at"].alias("a"), (r["a"] - 1).alias("b")))
        return F.struct(
            F.greatest(done["at"], r["b"] + 1).alias("at"),
            F.when(r["a"] > done["at"], F.concat(done["gaps"], gap)).otherwise(done["gaps"]).alias("gaps"),
        )

    swept = F.aggregate(ranges, begin, sweep)
    tail = F.when(swept["at"] <= top["last"], F.array(F.struct(swept["at"].alias("a"), top["last"].alias("b")))).otherwise(none)
    kept = F.flatten(F.transform(F.concat(swept["gaps"], tail), lambda g: F.sequence(g["a"], g["b"])))

    def piece(place: Column) -> Column:
        node = F.get(nodes, place)
        return (
            F.when(node["tag"] == "#text", node["text"])
            .when(node["tag"] == "br", F.lit(" "))
            .when(node["tag"].isin("#raw", "#json"), F.lit(""))
            .otherwise(F.lit(cleanup.MARK))
        )

    return cleanup.join_marked(F.array_join(F.transform(kept, piece), ""))
