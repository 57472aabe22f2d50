"""Near words, forms and roots against a comparison of all pairs, and the choice of pivots."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tarnlake.llm import spelling_variants as sv
from tests.llm.helpers import corpus, lowered

SCHEMA = "doc_id long, text string, word string, n int, other string"


def _counted(rows, divisor=97):
    counts = Counter()
    for key, text, *_ in rows:
        for run in re.findall("[a-zÀ-ÿ]+", lowered(text)):
            code = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if code % divisor == 0:
                at = code % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def _near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _brute(counts):
    near = {w: [v for v in counts if _near(w, v)] for w in counts}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best and counts[best] >= 2 * counts[w] else None
    rows = []
    for w in counts:
        root = w
        while forms[root]:
            root = forms[root]
        f = forms[w]
        rows.append((w, counts[w], len(near[w]), f, counts.get(f), root))
    return sorted(rows)


def _grouped(spark, counts):
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = sv.group_variants(words).select("word", "n", "n_near", "form", "form_n", "root")
    return sorted(map(tuple, got.collect()))


def _words(seed, letters, count, lengths=(5, 9)):
    rng = random.Random(seed)
    return {"".join(rng.choices(letters, k=rng.randint(*lengths))): rng.randint(3, 60) for _ in range(count)}


@pytest.mark.parametrize(
    "counts",
    [
        _words(1, "ab", 400, (5, 12)),
        _words(2, "abcé×÷ÿ", 900, (5, 8)),
        {"aaaaa" + "a" * k: 3 * 2**k for k in range(12)},
        {"abcde": 3, "abcdf": 6, "abcdg": 6, "abcgg": 12, "xbcde": 6},
        {"b" * 5000 + "x": 4, "b" * 5000 + "y": 9, "b" * 5001: 20},
        {"solid": 5},
        {},
    ],
    ids=["two letters", "accents", "chain", "ties", "very long", "one", "none"],
)
def test_groups(spark, counts):
    assert _grouped(spark, counts) == _brute(counts)


def test_documents_with_odd_rows(spark):
    rng = random.Random(5)
    base = [(i, t) for i, t, *_ in corpus()]
    base += [(None, "ÉCLAIRS Éclairs éclairs ÉCLAIRS"), (None, None), (7, "x" * 300_000 + " ok")]
    base += [(i, " ".join(rng.choices(["banana", "bananas", "bandana", "Banana"], k=300))) for i in range(400, 600)]
    base += base[-20:]
    df = spark.createDataFrame([(i, t, "w", 1, "o") for i, t in base], SCHEMA).repartition(4)
    words = sv.count_words(df, corrupt=sv.drop_one_in(97))
    counts = _counted(base)
    assert sorted(map(tuple, words.collect())) == sorted(counts.items())
    assert any(len(w) == 5 and _near(w, "banana") for w in counts)
    got = sv.group_variants(words).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert sorted(map(tuple, got)) == _brute(counts)


def test_no_documents(spark):
    words = sv.count_words(spark.createDataFrame([], SCHEMA))
    assert sv.group_variants(words).count() == 0


def test_words_too_short_for_two_pivots(spark):
    with pytest.raises(ValueError, match="shorter"):
        sv.count_words(spark.createDataFrame([], SCHEMA), min_chars=3)


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 50)), min_size=3, max_size=9, unique_by=lambda g: g[0]))
def test_pivots_are_the_lightest_disjoint_grams(grams):
    grams = sorted(grams)
    chosen = sv.pivots(grams)
    weight = dict(grams)
    best = min(weight[a] + weight[b] for a, b in itertools.combinations(weight, 2) if abs(a - b) >= 2)
    assert abs(chosen[0] - chosen[1]) >= 2 and sum(weight[p] for p in chosen) == best


@settings(max_examples=2000, deadline=None)
@given(st.text("abc", min_size=5, max_size=12), st.data())
def test_near_words_share_a_key(word, data):
    at = data.draw(st.integers(0, len(word) - 1))
    other = data.draw(st.sampled_from([
        word[:at] + word[at + 1 :], word[:at] + "c" + word[at:], word[:at] + "c" + word[at + 1 :],
    ]))
    if other == word or len(other) < 5:
        return
    present = Counter(w[i : i + 2] for w in (word, other) for i in range(len(w) - 1))
    weights = {g: data.draw(st.integers(1, 5)) for g in sorted(present)}
    grams = {w: sv.prefix_grams(w, weights) for w in (word, other)}
    filed = {w: {k for p, _ in grams[w][1] for k in sv._keys(w, p)} for w in grams}
    asked = {w: {k for p in sv.pivots(grams[w][0]) for k in sv._keys(w, p)} for w in grams}
    assert asked[word] & filed[other] or asked[other] & filed[word]
