"""Filter tails of a query as a predicate over flat rows (P5).

A tail is what stands behind the keywords of a search: words, "phrases", #tags, @names,
`lang:xx`, `from:name`, `to:name`, `is:kind` and `has:kind`, each with `-` before it for its
opposite, joined by blanks (and) or `OR`, in parentheses. `and` binds closer than `OR`. The
text is read into one boolean expression, so Spark plans it like any filter.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, functions as F

from .filters import keyword_match

TOKEN = re.compile(r'\s*(?:(?P<sign>[()-])|(?P<phrase>"(?:[^"\\]|\\.)*")|(?P<word>[^\s()"]+(?:"(?:[^"\\]|\\.)*")?))')
LISTED = ";"


class TailError(ValueError):
    """A tail that can't be read, or names an operator that is not known."""


def _filled(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("")) != ""


def _listed(column: str, value: str) -> Column:
    """Whether a list column holds a value, in any case."""
    items = F.split(F.lower(F.col(column)), LISTED)
    return F.array_contains(items, value.lower())


def _same(column: str, value: str) -> Column:
    return F.lower(F.col(column)) == value.lower()


def _media(kind: str) -> Callable[[], Column]:
    return lambda: _listed("media_types", kind)


# Kinds of posts and of contents that a tail may ask for, over the flat columns.
IS = {
    "retweet": lambda: F.col("is_retweet"),
    "reply": lambda: F.col("is_reply"),
    "quote": lambda: F.col("is_quote"),
    "verified": lambda: F.col("author_verified"),
}
HAS = {
    "media": lambda: _filled("media_keys"),
    "images": _media("photo"),
    "videos": _media("video"),
    "links": lambda: _filled("urls"),
    "hashtags": lambda: _filled("hashtags"),
    "mentions": lambda: _filled("mention_usernames"),
    "geo": lambda: _filled("place_id"),
}
VALUED = {
    "lang": lambda v: _same("lang", v),
    "from": lambda v: _same("author_username", v.removeprefix("@")),
    "to": lambda v: _listed("mention_usernames", v.removeprefix("@")) & F.col("is_reply"),
    "place_country": lambda v: _same("place_country_code", v),
    "conversation_id": lambda v: _same("conversation_id", v),
    "url": lambda v: F.contains(F.lower(F.concat_ws(LISTED, "urls", "expanded_urls")), F.lit(v.lower())),
}


def _choice(name: str, kinds: dict, value: str) -> Column:
    if value not in kinds:
        raise TailError(f"unknown operator {name}:{value}")
    return kinds[value]()


def _leaf(word: str, text: str) -> Column:
    name, colon, value = word.partition(":")
    if word.startswith('"'):
        return keyword_match(F.col(text), [word.replace('\\"', '"')])
    if word.startswith("#") and len(word) > 1:
        return _listed("hashtags", word[1:])
    if word.startswith("@") and len(word) > 1:
        return _listed("mention_usernames", word[1:])
    if not colon:
        return keyword_match(F.col(text), [word])
    if len(value) > 1 and value[0] == value[-1] == '"':
        value = value[1:-1]
    if not value:
        raise TailError(f"operator {name}: has no value")
    if name == "is":
        return _choice(name, IS, value)
    if name == "has":
        return _choice(name, HAS, value)
    if name not in VALUED:
        raise TailError(f"unknown operator {name}:")
    return VALUED[name](value)


def tokens(tail: str) -> list[tuple[str, str]]:
    """(kind, text) of each token; a sign is `(`, `)` or `-`."""
    out, at = [], 0
    tail = tail.rstrip()
    while at < len(tail):
        m = TOKEN.match(tail, at)
        if m is None:
            raise TailError(f"no end of the phrase at {tail[at:at + 20]!r}")
        kind, text = m.lastgroup, m[m.lastgroup]
        out.append(("or", text) if kind == "word" and text == "OR" else (text if kind == "sign" else kind, text))
        at = m.end()
    return out


def tail_filter(tail: str | None, text: str = "text") -> Column:
    """P5: the predicate of a tail; a blank tail lets every row pass.

    A row lacks what it has no value for: `lang:ja` is false without a language and `-lang:ja`
    true. Only columns that the tail names need to be there. An unknown operator, an open
    phrase or parenthesis, and an `OR` without two sides are errors.
    """
    left = tokens(tail or "")
    if not left:
        return F.lit(True)

    def either() -> Column:
        sides = [every()]
        while left and left[0][0] == "or":
            left.pop(0)
            sides.append(every())
        return reduce(lambda a, b: a | b, sides)

    def every() -> Column:
        parts = []
        while left and left[0][0] not in ("or", ")"):
            parts.append(one())
        if not parts:
            raise TailError("a term is missing" if not left else f"a term is missing before {left[0][1]!r}")
        return reduce(lambda a, b: a & b, parts)

    def one() -> Column:
        kind, word = left.pop(0)
        if kind == "-":
            if not left or left[0][0] in ("or", ")"):
                raise TailError("nothing behind -")
            return ~one()
        if kind == "(":
            inner = either()
            if not left or left.pop(0)[0] != ")":
                raise TailError("a parenthesis is not closed")
            return inner
        return F.coalesce(_leaf(word, text), F.lit(False))

    found = either()
    if left:
        raise TailError("a parenthesis is not opened")
    return found
