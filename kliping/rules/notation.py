"""Short forms for writing rule rows."""

from __future__ import annotations


def at(tag, value=None, attr="class", pick=1, axis="in"):
    """One step: an element by tag and, if given, an attribute value."""
    return {"axis": axis, "tag": tag, "attr": attr if value is not None else None, "value": value, "pick": pick}


def every(tag, value=None, attr="class"):
    return at(tag, value, attr, pick=0)


def having(tag, attr, pick=1):
    """An element that carries an attribute, whatever its value."""
    return {"axis": "in", "tag": tag, "attr": attr, "value": None, "pick": pick}


def rule(kind, steps=(), take=None, block=None, path=None, pattern=None, remove=None, only=None):
    return {
        "kind": kind, "steps": list(steps), "take": take, "block": block,
        "path": path, "pattern": pattern, "remove": remove, "only": only,
    }


def node(*steps, take="text", pattern=None, remove=None, only=None):
    """``only`` limits a body rule to pages of one category, or with ``!`` in front to those of all others."""
    return rule("node", steps, take=take, pattern=pattern, remove=remove, only=only)


def meta(name, attr="property", pick=1):
    return node(at("meta", name, attr, pick), take="content")


def ld(path, block="first", pattern=None):
    return rule("jsonld", block=block, path=path, pattern=pattern)


def const(value):
    return rule("const", path=value)


def link(part):
    return rule("link", take=part)


def url(pattern):
    return rule("url", pattern=pattern)


def need(name, *steps):
    return {"name": name, "rule": node(*steps, take="id")}


def ban(field, *words):
    return {"field": field, "words": list(words)}


def drop(tag, value=None, attr="class", phrase=None, child=None, also=None, mode="all", when=None, tail=0):
    """Remove elements below the body.

    ``phrase`` is looked for in the text of the first ``child`` if one is named
    (with ``mode='self'`` in the element's own text); ``also`` names tags that
    must occur inside; ``when`` must occur in the whole body; ``tail`` keeps the
    removal to the last so many. Modes ``after`` (all that starts after the
    first hit) and ``byline`` (paragraphs that repeat the author).
    """
    return {
        "step": at(tag, value, attr, pick=-tail), "mode": mode, "phrase": phrase,
        "child": child, "also": also, "when": when,
    }
