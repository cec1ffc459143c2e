"""Text and markup cleanup as Column expressions.

Everything here stays in the JVM except ``nfkd`` and ``unescape``, which have
no built-in counterpart and go through Arrow in whole batches.
"""

from __future__ import annotations

import html as html_module

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# --- fixed values -----------------------------------------------------------
# White space as Python's str.strip() knows it, as a regex class body ...
WS_CLASS = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# ... and as plain characters for trimming.
WS_CHARS = "".join(
    chr(c)
    for c in [
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    ]
)
# Named entities the native path resolves; "&amp;" has to come last.
COMMON_ENTITIES = [
    ("&nbsp;", "\u00a0"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&#39;", "'"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]
QUOTES = "‘'"
# -----------------------------------------------------------------------------

TAG = r"(?s)<!--.*?-->|</?[a-zA-Z!][^>]*>"
MARK = "\u0001"


def strip_text(text: Column) -> Column:
    """Trim Unicode white space at both ends."""
    return F.btrim(text, F.lit(WS_CHARS))


def btrim_text(text: Column, chars: str = " \t\n\r") -> Column:
    return F.btrim(text, F.lit(chars))


def tag_pattern(tag: str, attribute: str = "") -> str:
    """A flat element of one tag, from its start tag to the next end tag."""
    return rf"<{tag}\b[^>]*{attribute}[^>]*>.*?</{tag}\s*>"


def drop_tags(html: Column, tags: list[str], comments: bool = True) -> Column:
    """Remove flat (not self-nesting) elements with their content."""
    parts = [tag_pattern(tag) for tag in tags] + (["<!--.*?-->"] if comments else [])
    return F.regexp_replace(html, "(?is)" + "|".join(parts), "")


def drop_elements(html: Column, tag: str, attribute: str, value: str) -> Column:
    """Remove flat elements carrying one attribute value."""
    return F.regexp_replace(html, "(?is)" + tag_pattern(tag, f'{attribute}="{value}"'), "")


def element(html: Column, tag: str) -> Column:
    """Inner markup of the first element of a tag, '' when there is none."""
    return F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)


def elements(html: Column, tag: str) -> Column:
    """Inner markup of all (flat) elements of a tag, in document order."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"), F.lit(1))


def br_to_space(html: Column) -> Column:
    return F.regexp_replace(html, r"(?i)<br\s*/?>", " ")


def join_marked(text: Column) -> Column:
    """Strip the parts between marks and join them with nothing."""
    return F.array_join(F.transform(F.split(text, MARK), strip_text), "")


def html_text(html: Column) -> Column:
    """Strip every text node, drop empty ones and join with no separator."""
    return join_marked(F.regexp_replace(html, TAG, MARK))


def strip_control(text: Column) -> Column:
    """Line feeds, tabs and carriage returns vanish; they become no spaces."""
    for control in "\n\t\r":
        text = F.replace(text, F.lit(control), F.lit(""))
    return text


def truncate_phrase(text: Column, phrase: str) -> Column:
    """Cut one line of text from a phrase on."""
    return F.regexp_replace(text, rf"{phrase}[^\n]*", "")


def strip_quotes(text: Column, quotes: str = QUOTES) -> Column:
    return F.translate(text, quotes, "")


def cut_after(text: Column, marker: str) -> Column:
    """Everything before the first marker; the whole text without one."""
    return F.substring_index(text, marker, 1)


def drop_phrases(paragraphs: Column, phrases: list[str]) -> Column:
    """Drop the paragraphs that hold one of the phrases, in any case."""

    def clear(paragraph: Column) -> Column:
        lowered = F.lower(paragraph)
        hit = F.lit(False)
        for phrase in phrases:
            hit = hit | lowered.contains(phrase.lower())
        return ~hit

    return F.filter(paragraphs, clear)


def drop_tail(paragraphs: Column, n: int, text: Column, phrase: str) -> Column:
    """Drop the last ``n`` paragraphs where ``text`` holds the phrase."""
    kept = F.slice(paragraphs, F.lit(1), F.greatest(F.size(paragraphs) - n, F.lit(0)))
    return F.when(F.lower(text).contains(phrase.lower()), kept).otherwise(paragraphs)


def drop_byline(paragraphs: Column, author: Column) -> Column:
    return F.filter(paragraphs, lambda p: p != author)


def soft_fallback(strict: Column, soft: Column) -> Column:
    """Use the softer cleaning where the strict one left nothing."""
    return F.when(strict == "", soft).otherwise(strict)


def unescape_common(text: Column) -> Column:
    for entity, char in COMMON_ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


@F.pandas_udf(StringType())
def unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html_module.unescape, na_action="ignore")


@F.pandas_udf(StringType())
def nfkd(texts: pd.Series) -> pd.Series:
    return texts.str.normalize("NFKD")


def normalized(text: Column) -> Column:
    """NFKD of a computed text; plain ASCII stands for itself, and NULL goes to Python for it.

    The text is used more than once here, so Catalyst computes it below the
    Python step. (An argument that nests lambdas cannot move into one.)
    """
    return F.coalesce(nfkd(F.when(~text.rlike(r"^\p{ASCII}*+$"), text)), text)
