"""Toxicity by a learned lexicon, Levenshtein automata and context windows.

The lexicon is learned: words of the labelled sample whose document share is much larger
among toxic documents, weighted by the logarithm of the two shares' ratio. It is held as a
trie. A word is looked up by running the word's Levenshtein automaton and the trie together: a
state is a node of the trie, the letters of the word read, and the edits made. Without an edit
left only the branch of the word's remaining letters can be taken, so a walk leaves most
branches at once. The distance follows from the term's length, and two letters that
changed places are one edit. Words that the sample's harmless documents use themselves are
no misspellings.

Every hit is weighed by the words around it: quotation marks around it, or a reporting word
near it, make it a quotation; a second person near it makes it abuse. A document's sum,
its density and the number of its different terms go into a logistic regression.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import durable
from .common import batch, chunks
from .learning import TRAIN_ROWS, labelled_sample, logistic, sigmoid

#: Toxic documents that must hold a term, as a number and as a share (so their number is bounded
#: by the sample's words), its least log ratio and significance.
LEAST_DOCS = 3
LEAST_SHARE = 0.004
LEAST_RATIO = 2.0
LEAST_Z = 5.0
#: Terms from so many letters on are found at one edit, a swap of neighbours among them, and
#: at two edits in words that hold marks or digits. Two edits turn plain words into each
#: other too often.
ONE_EDIT, TWO_IF_MARKED = 4, 8
#: A word near a term is no misspelling if so many harmless documents hold it, as a number
#: and as a share, and toxic ones don't hold it with a share larger by this significance.
LEAST_CLEAN, LEAST_CLEAN_SHARE, CLEAN_Z = 2, 0.0002, 2.0
#: Weight of a misspelled term, a quoted one, one thrown at somebody.
MISSPELLED, QUOTED, ABUSIVE = 0.8, 0.3, 1.3
#: Words to each side that make the context.
WINDOW = 8
#: Words that a worker's memo holds before it starts anew.
MEMO_WORDS = 250_000

# Words and marks that tell a quotation or an address.
REPORTING = frozenset("said says saying quote quoted quotes quoting wrote writes called termed reported cited".split())
SECOND_PERSON = frozenset("you your yours you're youre yourself u ur".split())
OPENING, CLOSING = "\"“«„‘", "\"”»“’"
PARTNER = {"\"": "\"", "“": "”", "«": "»", "„": "“", "‘": "’"}

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def reach(term: str, marked: bool) -> int:
    """Edits that a misspelling of the term may have, in a word with or without marks."""
    n = len(term)
    return (n >= ONE_EDIT) + (marked and n >= TWO_IF_MARKED)


def bare(word: str) -> str:
    """A lower-case word without marks at its ends."""
    return word if word.isalnum() else _EDGE.sub("", word)


class Trie:
    """Terms by letters; each node is a dict, a term ends where None is a key."""

    def __init__(self, terms: Iterable[str]):
        # One trie for each number of edits that words, with marks or without, may need.
        self.roots: dict[bool, list[tuple[int, dict, int, int, int]]] = {False: [], True: []}
        for marked, roots in self.roots.items():
            for edits in (1, 2):
                some = [t for t in terms if reach(t, marked) == edits]
                if some:
                    sizes, letters = [len(t) for t in some], min(sum(map(str.isalpha, t)) for t in some)
                    roots.append((edits, self.branches(some), min(sizes) - edits, max(sizes) + edits, letters - edits))

    @staticmethod
    def branches(terms: Iterable[str]) -> dict:
        root: dict = {}
        for t in terms:
            node = root
            for c in t:
                node = node.setdefault(c, {})
            node[None] = t
        return root

    def near(self, word: str) -> list[str]:
        """Terms within their own reach of the word, the word itself aside."""
        marked, n, found = not word.isalpha(), len(word), set()
        letters = sum(map(str.isalpha, word)) if marked else n
        for edits, root, shortest, longest, least in self.roots[marked]:
            if shortest <= n <= longest and letters >= least:
                self._walk(root, word, edits, found)
        found.discard(word)
        return list(found)

    @staticmethod
    def _walk(root: dict, word: str, most: int, found: set[str]) -> None:
        """Add the terms that the automaton accepts with `most` edits or fewer."""
        n = len(word)
        todo = [(root, 0, 0)]
        while todo:
            node, i, made = todo.pop()
            if made == most:  # the rest of the word, letter by letter
                while i < n and node is not None:
                    node = node.get(word[i])
                    i += 1
                if node is not None and None in node:
                    found.add(node[None])
                continue
            if i == n and None in node:
                found.add(node[None])
            here = word[i] if i < n else None
            after = word[i + 1] if i + 1 < n else None
            last = made + 1 == most  # then a branch must go on with the letter that comes next
            if i < n and (not last or after in node):
                todo.append((node, i + 1, made + 1))  # the word has a letter more
            for letter, child in node.items():
                if letter is None:
                    continue
                if letter == here:
                    todo.append((child, i + 1, made))
                elif i < n:
                    if not last or after in child:
                        todo.append((child, i + 1, made + 1))  # another letter
                    if letter == after and here in child:
                        todo.append((child[here], i + 2, made + 1))  # two letters changed places
                if not last or here in child:
                    todo.append((child, i, made + 1))  # the term has a letter more


@dataclass
class Model:
    terms: dict[str, float]
    harmless: set[str]
    weights: np.ndarray | None
    prior: float = 0.0


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.trie = Trie(model.terms)
        self.memo: dict[str, tuple[str, float] | None] = {}

    def look_up(self, word: str) -> tuple[str, float] | None:
        w = bare(word)
        if w in self.model.terms:
            return w, self.model.terms[w]
        if w in self.model.harmless:
            return None
        near = self.trie.near(w)
        if not near:
            return None
        best = max(near, key=lambda t: (self.model.terms[t], t))
        return best, MISSPELLED * self.model.terms[best]

    def measure(self, text: str | None) -> tuple[float, int, int, int, int]:
        """Weight of the hits, different terms, hits, quoted hits, words."""
        if not text:
            return 0.0, 0, 0, 0, 0
        words = text.lower().split()
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        hit_words = {}
        for w in set(words):
            if w in memo:
                hit = memo[w]
            else:
                hit = memo[w] = self.look_up(w)
            if hit is not None:
                hit_words[w] = hit
        if not hit_words:
            return 0.0, 0, 0, 0, len(words)
        total, quoted, hits, terms = 0.0, 0, 0, set()
        for i, w in enumerate(words):
            hit = hit_words.get(w)
            if hit is None:
                continue
            hits += 1
            terms.add(hit[0])
            weight = hit[1]
            lo = max(0, i - WINDOW)
            around = words[lo : i + WINDOW + 1]
            bares = {bare(x) for x in around}
            if bares & REPORTING or between_marks(around, i - lo):
                quoted += 1
                weight *= QUOTED
            elif bares & SECOND_PERSON:
                weight *= ABUSIVE
            total += weight
        return total, len(terms), hits, quoted, len(words)


def between_marks(words: list[str], at: int) -> bool:
    """Whether a mark opens at or before the word and its partner closes at or behind it."""
    for i in range(at, -1, -1):
        if i < at and (words[i].rstrip(".,;:!?")[-1:] or " ") in CLOSING:
            return False
        opening = words[i][0]
        if opening in OPENING:
            closing = PARTNER[opening]
            return any(closing in words[j].lstrip(OPENING) for j in range(at, len(words)))
    return False


def features(measured: np.ndarray) -> np.ndarray:
    total, terms, hits, _, words = measured.T
    per = 100 * total / np.maximum(words, 1)
    return np.column_stack(
        [np.log1p(total), np.log1p(terms), np.log1p(per), np.log1p(hits), np.log1p(total) * np.log1p(per), terms > 1, terms > 2]
    )


_COUNTS = pa.schema([("word", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
_MEASURED = pa.schema(
    [(n, pa.float64() if n == "total" else pa.int64()) for n in ("total", "terms", "hits", "quoted", "words")]
)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = TRAIN_ROWS) -> Model:
    """Lexicon and weights from at most `rows` labelled documents."""
    sample = labelled_sample(docs, labels, "toxic", learn, rows)
    sizes = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    n1, n0 = sizes.get(1, 0), sum(n for k, n in sizes.items() if k != 1)
    if not n1 or not n0:
        return Model({}, set(), None, float(bool(n1)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = Counter(), Counter()
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen[label == 1].update({bare(w) for w in set((text or "").lower().split())})
            either = list(seen[0].keys() | seen[1].keys())
            yield batch(_COUNTS, word=either, toxic=[seen[1][w] for w in either], clean=[seen[0][w] for w in either])

    counts = (
        sample.select("text", "label")
        .mapInArrow(count, "word STRING, toxic LONG, clean LONG")
        .groupBy("word")
        .agg(F.sum("toxic").alias("n1"), F.sum("clean").alias("n0"))
        .where("word <> ''")
    )
    counts = durable(counts, "words")  # read for the lexicon and for its harmless neighbours
    p1, p0 = (F.col("n1") + 0.5) / (n1 + 1), (F.col("n0") + 0.5) / (n0 + 1)
    share = (F.col("n1") + F.col("n0")) / (n1 + n0)
    z = (p1 - p0) / F.sqrt(share * (1 - share) * (1 / n1 + 1 / n0) + 1e-12)
    found = (
        counts.where((F.col("n1") >= max(LEAST_DOCS, LEAST_SHARE * n1)) & (F.log(p1 / p0) >= LEAST_RATIO) & (z >= LEAST_Z))
        .select("word", F.log(p1 / p0).alias("weight"))
        .collect()
    )
    terms = {r["word"]: float(r["weight"]) for r in found}

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(terms)
        for b in batches:
            near = [w for w in b.column(0).to_pylist() if w not in terms and trie.near(w)]
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], ["word"])

    # Of the sample's words those within reach of a term that harmless documents repeat.
    clean = (F.col("n0") >= max(LEAST_CLEAN, LEAST_CLEAN_SHARE * n0)) & (z < CLEAN_Z)
    common = counts.where(clean).select("word").mapInArrow(neighbours, "word STRING")
    model = Model(terms, {r[0] for r in common.collect()}, None)
    measured = _measured(sample, model).toPandas()
    x = features(measured[_MEASURED.names].to_numpy(float))
    model.weights = logistic(x, (measured["label"] == 1).to_numpy(float))
    return model


def _measured(sample: DataFrame, model: Model) -> DataFrame:
    """Label and measures of each text of the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in batches:
            for lo, hi in chunks(b.column(1)):
                part = b.slice(lo, hi - lo)
                rows = [scorer.measure(t) for t in part.column(1).to_pylist()]
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _MEASURED)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["label", *_MEASURED.names])

    kinds = "total DOUBLE, terms LONG, hits LONG, quoted LONG, words LONG"
    return sample.select("label", "text").mapInArrow(run, f"label INT, {kinds}")


def line(model: Model, measured: np.ndarray) -> np.ndarray:
    """Scores of measures."""
    if model.weights is None:
        return np.full(len(measured), model.prior)
    x = features(measured)
    return sigmoid((x * model.weights[:-1]).sum(1) + model.weights[-1])


def judge(model: Model, least: float):
    """For `common.keep_where`: keeps texts that score below `least`."""

    def make():
        scorer = Scorer(model)

        def keeps(texts: pa.Array) -> np.ndarray:
            rows = [scorer.measure(t) for t in texts.to_pylist()]
            return line(model, np.array(rows, float).reshape(-1, len(_MEASURED))) < least

        return keeps

    return make


_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("hits", pa.int64()), ("quoted", pa.int64())])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1), hits and quoted (hits in quotations) of every row of `docs`
    (doc_id, text).

    Null and empty texts have no hits and get the score of a text without hits. Null ids
    are kept, repeated rows are scored each, other columns are dropped, an empty table gives
    an empty table. With labels of one kind only, every score is 1 or 0, with none 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in batches:
            for lo, hi in chunks(b.column(1)):
                part = b.slice(lo, hi - lo)
                rows = np.array([scorer.measure(t) for t in part.column(1).to_pylist()], float)
                yield batch(
                    _SCORES,
                    doc_id=part.column(0),
                    score=line(model, rows),
                    hits=rows[:, 2].astype(np.int64),
                    quoted=rows[:, 3].astype(np.int64),
                )

    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return own.mapInArrow(run, "doc_id LONG, score DOUBLE, hits LONG, quoted LONG")
