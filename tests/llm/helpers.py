"""Brute-force versions and small tables that the operator tests share."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def vocabulary(rng, size=400):
    return ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(size)]


def corpus(seed=1, count=60):
    """(doc_id, text, lang, source): copies, near copies, shared passages, odd and empty texts."""
    rng = random.Random(seed)
    vocab = vocabulary(rng)
    passage = " ".join(rng.choices(vocab, k=60))
    line = "A line that many of the documents share"
    texts = []
    for i in range(count):
        body = [" ".join(rng.choices(vocab, k=rng.randint(5, 40))) for _ in range(rng.randint(1, 6))]
        if i % 5 == 0:
            body.insert(rng.randint(0, len(body)), passage)
        if i % 4 == 0:
            body.append(("  " if i % 8 else "") + (line.upper() if i % 3 else line))
        texts.append("\n".join(body))
    for i in range(0, count, 6):
        texts.append(texts[i])  # exact copies
        near = words(texts[i])
        near[rng.randrange(len(near))] = "changed"
        texts.append(" ".join(near))
    texts += [None, "", " \n\t ", "one", "one", "two words", "é à ü", "12 34 !!", "\n\n"]
    texts.append(" ".join(rng.choices(vocab, k=6000)))
    rows = [(i, t, ["en", "fr", None][i % 3], ["b", "a", None, "Ä"][i % 4]) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


def table(spark, rows=None, schema=SCHEMA):
    return spark.createDataFrame(corpus() if rows is None else rows, schema).repartition(3)


def components(sets, percent=80):
    """Smallest id reachable over set pairs of the required similarity."""
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in sets}


def shingles(text, size=5):
    w = words(lowered(text))
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}
