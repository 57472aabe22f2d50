"""Factors of repeated passages: each copied word for word from an earlier document, whole copies long."""

from __future__ import annotations

import random

import pytest

from tarnlake.llm import substring_dedup
from tests.llm.helpers import corpus, table, vocabulary, words


def _check(rows, got, window):
    by_id = {}
    for key, text, *_ in rows:
        by_id.setdefault(key, []).append(words(text))
    for r in got:
        covered, last = set(), 0
        own = next((w for w in by_id[r.doc_id] if len(w) == r.n_words and (r.doc_id, " ".join(w)) in texts(rows, r, w)), None)
        for f in r.factors:
            assert f.start >= last and f.length > 0 and f.source_id < r.doc_id
            last = f.start + f.length
            copied = [w[f.source_word : f.source_word + f.length] for w in by_id[f.source_id]]
            assert own[f.start : f.start + f.length] in copied
            covered |= set(range(f.start, f.start + f.length))
        spans = {i for s in r.spans for i in range(s.start, s.end)}
        assert covered == spans and len(spans) == r.n_removed
        assert r.text == " ".join(w for i, w in enumerate(own) if i not in spans)


def texts(rows, r, own):
    """The row's own words: those whose kept part is the result."""
    spans = {i for s in r.spans for i in range(s.start, s.end)}
    kept = " ".join(w for i, w in enumerate(own) if i not in spans)
    return {(r.doc_id, " ".join(own))} if kept == r.text else set()


@pytest.mark.parametrize("window", [50, 7])
def test_factors_are_copies(spark, window):
    rows = corpus(4)
    rng = random.Random(2)
    vocab = vocabulary(rng, 30)
    rows += [(1000 + i, " ".join(rng.choices(vocab[: 3 if i % 2 else 30], k=120)), None, None) for i in range(20)]
    rows += [(1003, rows[5][1], None, None), (None, rows[6][1], None, None)]
    got = substring_dedup.drop_repeated_passages(table(spark, rows), window=window).collect()
    _check(rows, [r for r in got if r.doc_id is not None], window)
    assert sum(len(r.factors) for r in got) > 10


def test_one_long_copy_is_one_factor(spark):
    rng = random.Random(8)
    vocab = vocabulary(rng, 3000)
    source = rng.choices(vocab, k=2000)
    own = rng.choices(vocab, k=300)
    rows = [(1, " ".join(source), None, None), (2, " ".join(own[:100] + source[137:1637] + own[100:]), None, None)]
    frame = table(spark, rows).withColumnRenamed("lang", "spans").withColumnRenamed("source", "id")
    got = {r.doc_id: r for r in substring_dedup.drop_repeated_passages(frame).collect()}
    assert got[1].factors == []
    assert [tuple(f) for f in got[2].factors] == [(100, 1, 137, 1500)]
