"""Plain versions of the operators, to compare with."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(text or "")
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard_classes(rows):
    """{position: (class, links)} of (doc_id, text) rows."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 5 * both >= 4 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    least = defaultdict(lambda: float("inf"))
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least[root(i)], doc_id)
    return [(doc_id, least[root(i)], links[i]) for i, (doc_id, _) in enumerate(rows)]


def cut(rows, window=50):
    """(doc_id, n_words, n_removed, kept) of (doc_id, text) rows with ids."""
    starts = defaultdict(set)
    split = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - window + 1):
            starts[tuple(w[i : i + window])].add(d)
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if min(starts[tuple(w[i : i + window])]) < d:
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), " ".join(kept)))
    return out


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]
