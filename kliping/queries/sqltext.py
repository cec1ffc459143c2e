"""SQL fragments the checking statements share (DuckDB dialect)."""

from kliping.functions.cleanup import COMMON_ENTITIES, WS_CLASS

WHOLE = r"regexp_replace(regexp_replace(url, '#.*$', ''), '([?&])page=all(&|$)', '\1', 'g')"
KEY = f"rtrim(regexp_replace({WHOLE}, '[?&]+$', ''), '/')"
HOST = "regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)"
BASE = "regexp_extract(url, '^([a-z]+://[^/?#]+)', 1)"
PATH = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/?#]+/?', '')"
SEGMENTS = f"list_filter(string_split({PATH}, '/'), lambda s: s <> '')"


def strip(sql: str) -> str:
    return f"regexp_replace(regexp_replace({sql}, '^[{WS_CLASS}]+', ''), '[{WS_CLASS}]+$', '')"


def unescape(sql: str) -> str:
    for entity, char in COMMON_ENTITIES:
        quoted = char.replace("'", "''")
        sql = f"replace({sql}, '{entity}', '{quoted}')"
    return sql


def element(html: str, tag: str) -> str:
    return rf"regexp_extract({html}, '(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>', 1)"


def elements(html: str, tag: str) -> str:
    return rf"regexp_extract_all({html}, '(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>', 1)"


def br(html: str) -> str:
    return rf"regexp_replace({html}, '(?i)<br\s*/?>', ' ', 'g')"


def drop(html: str, tags: list[str]) -> str:
    parts = "|".join([rf"<{t}\b[^>]*>.*?</{t}\s*>" for t in tags] + ["<!--.*?-->"])
    return f"regexp_replace({html}, '(?is){parts}', '', 'g')"


def text(html: str) -> str:
    """Strip each text node, drop the empty ones, join with nothing."""
    nodes = rf"string_split(regexp_replace({html}, '(?s)<!--.*?-->|</?[a-zA-Z!][^>]*>', chr(1), 'g'), chr(1))"
    return f"array_to_string(list_transform({nodes}, lambda t: {strip('t')}), '')"


def control(sql: str) -> str:
    return rf"regexp_replace({sql}, '[\n\t\r]', '', 'g')"
