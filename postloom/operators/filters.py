"""Keyword, flag and time predicates, and rule matching."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.coerce import strip
from .skew import lookup_join

# A word character of any script.
WORD = r"\p{L}\p{N}_"


def quoted_term(term: Column) -> Column:
    """A term as it stands in the query text; phrases are quoted once."""
    text = strip(term)
    phrase = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('\\"')), F.lit('"'))
    is_quoted = text.startswith('"') & text.endswith('"')
    return F.when(is_quoted, text).when(text.rlike(r"(?U)\s"), phrase).otherwise(text)


def query_text(keywords: Column, tail: Column, exclude_reposts: Column) -> Column:
    """Query text of a task; null when no keyword is left."""
    terms = F.filter(F.transform(keywords, quoted_term), lambda t: t != "")
    rest = strip(F.coalesce(tail, F.lit("")))
    text = F.concat(
        F.lit("("),
        F.array_join(terms, " OR "),
        F.lit(")"),
        F.when(rest != "", F.concat(F.lit(" "), rest)).otherwise(""),
        F.when(exclude_reposts, " -is:retweet").otherwise(""),
    )
    return F.when(F.size(terms) > 0, text)


def term_words(term: str) -> list[str]:
    text = term.strip()
    if len(text) > 1 and text.startswith('"') and text.endswith('"'):
        text = text[1:-1]
    return text.split()


def keyword_pattern(terms: list[str]) -> str:
    """Pattern of word-bounded, case-insensitive terms; blanks in a phrase match any run of blanks."""
    parts = [r"\s+".join(re.escape(w) for w in term_words(t)) for t in terms if term_words(t)]
    if not parts:
        raise ValueError("no valid keyword")
    return rf"(?iu)(^|[^{WORD}])({'|'.join(parts)})([^{WORD}]|$)"


def keyword_match(text: Column, terms: list[str]) -> Column:
    """P3 as a predicate, in one pass over the text for all terms."""
    return F.coalesce(text.rlike(keyword_pattern(terms)), F.lit(False))


def post_filter(
    lang: str | None = None,
    exclude_reposts: bool = True,
    exclude_replies: bool = False,
    exclude_quotes: bool = False,
) -> Column:
    """P4/P5 over the flat flags."""
    checks = [F.lit(True)]
    if lang is not None:
        checks.append(F.col("lang") == lang)
    if exclude_reposts:
        checks.append(~F.col("is_retweet"))
    if exclude_replies:
        checks.append(~F.col("is_reply"))
    if exclude_quotes:
        checks.append(~F.col("is_quote"))
    return reduce(lambda a, b: a & b, checks)


def time_range(ts: Column, start: Column | None = None, end: Column | None = None) -> Column:
    """Half-open, so neighbouring windows share no post."""
    check = F.lit(True)
    if start is not None:
        check = check & (ts >= start)
    if end is not None:
        check = check & (ts < end)
    return check


@dataclass(frozen=True)
class Rule:
    """A standing rule."""

    id: str
    tag: str
    keywords: tuple[str, ...]
    lang: str | None = None
    exclude_reposts: bool = False


def match_rules(posts: DataFrame, rules: list[Rule]) -> DataFrame:
    """J10 for configured rules: `matching_rules` sorted by id, computed in the scan.

    The rules are part of the program, so no join and no shuffle is needed.
    """
    hits = []
    for rule in sorted(rules, key=lambda r: r.id):
        check = keyword_match(F.col("text"), list(rule.keywords))
        if rule.lang is not None or rule.exclude_reposts:
            check = check & F.coalesce(post_filter(rule.lang, rule.exclude_reposts), F.lit(False))
        named = F.struct(F.lit(rule.id).alias("id"), F.lit(rule.tag).alias("tag"))
        hits.append(F.when(check, named))
    return posts.withColumn("matching_rules", F.array_compact(F.array(*hits)))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(rf"[{WORD}]+"), F.lit(0))


def match_rule_table(posts: DataFrame, rules: DataFrame, key: str = "id") -> DataFrame:
    """J10 for a table of rules `(rule_id, tag, term)`: `key` and `matching_rules` (sorted by
    id) of every post that a rule matches, a row per post.

    Not a nested loop: each term is found by its longest word, in an equi-join with the
    distinct words of the posts. A small rule table is broadcast after a check of its size;
    for a big one, frequent words are spread over tasks. Only phrases go
    back to the text. Terms need at least one word.
    """
    # Quotes around the whole term go; a single one belongs to it, as in `keyword_match`.
    terms = rules.select(
        "rule_id", "tag", F.lower(strip(F.regexp_replace(strip(F.col("term")), '(?s)^"(.*)"$', "$1"))).alias("term")
    )
    # Posts meet each different term once, however many rules have it.
    terms = terms.groupBy("term").agg(F.collect_set(F.struct(F.col("rule_id").alias("id"), "tag")).alias("rules"))
    terms = terms.withColumn("_words", words_of(F.col("term")))
    longest = F.array_max(F.transform("_words", lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))
    terms = terms.where(F.size("_words") > 0).withColumns(
        {"word": longest["w"], "is_word": F.col("_words")[0] == F.col("term")}
    ).drop("_words")
    words = posts.select(key, F.explode(F.array_distinct(words_of(F.col("text")))).alias("word"))
    near = lookup_join(words, terms, ["word"], [key], "inner").select(key, "rules", "term", "is_word")
    exact = near.where("is_word").select(key, "rules")
    # Regex metacharacters of the term are quoted; blanks stand for any run of blanks.
    quoted = F.regexp_replace("term", r"([^\p{L}\p{N}_\s])", r"\\$1")
    pattern = F.concat(
        F.lit(rf"(?iu)(^|[^{WORD}])"),
        F.regexp_replace(quoted, r"\s+", r"\\s+"),
        F.lit(rf"([^{WORD}]|$)"),
    )
    # A plain search in the text with single blanks settles most candidates; the pattern
    # then checks the word borders.
    texts = posts.select(key, "text", F.regexp_replace(F.lower("text"), r"\s+", " ").alias("_flat"))
    phrases = (
        near.where("not is_word")
        .withColumn("_needle", F.regexp_replace("term", r"\s+", " "))
        .join(texts, key)
        .where(F.when(F.contains("_flat", "_needle"), F.rlike("text", pattern)).otherwise(False))
        .select(key, "rules")
    )
    found = exact.unionByName(phrases).groupBy(key).agg(F.flatten(F.collect_list("rules")).alias("_rules"))
    return found.select(key, F.array_sort(F.array_distinct("_rules")).alias("matching_rules"))
