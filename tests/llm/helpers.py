"""Brute force for the operators."""

from __future__ import annotations

import re
import string

ASCII_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, source=lambda i: f"s{i % 4}"):
    """A table of documents; ``texts`` may hold None."""
    rows = [(i, t, "en", source(i), None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def spaced_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))


def shingle_set(text, k):
    words = spaced_words(text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def roots(ids, linked):
    """Smallest id reachable from each id over pairs for which ``linked`` holds."""
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(ids)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if linked(a, b):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def variants(rng, words, n, most):
    """``n`` edited copies of a list of words, with up to ``most`` words replaced."""
    out = []
    for _ in range(n):
        copy = list(words)
        for _ in range(rng.randint(0, most)):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out
