"""Leak search against all pairs: the exact search, the recall of the cosine, rows without an own id."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tarnlake.llm import decontaminate
from tarnlake.llm.decontaminate import BLOCK, common_words
from tests.llm.helpers import table, vocabulary

ITEMS = "item_id long, text string"


def _corpus(seed=3, count=120, odd=True):
    """Documents that hold items whole, with words replaced, or in part with the answer."""
    rng = random.Random(seed)
    vocab = vocabulary(rng, 250)
    items = []
    for i in range(25):
        lines = [" ".join(rng.choices(vocab, k=rng.randint(8, 16))) for _ in range(2)]
        items.append((i, ". ".join(lines) + "."))
    rows, kinds = [], {}
    for i in range(count):
        body = rng.choices(vocab, k=rng.randint(0, 300))
        if i % 3 == 0:
            key, text = items[rng.randrange(25)]
            head, tail = (part.strip(" .").split() for part in text.split(". "))
            kind = i // 3 % 3
            if kind == 0:
                own = head + tail
            elif kind == 1:
                own = [rng.choice(vocab) if rng.random() < 0.2 else w for w in head + tail]
            else:
                own = [w for w in head if rng.random() < 0.4] + tail
            kinds[(i, key)] = kind
            at = rng.randint(0, len(body))
            body[at:at] = own
        rows.append((i, " ".join(body), None, None))
    return rows, items, kinds


def _brute(rows, items, common=0.7, loose=0.5, answer=0.8):
    """Every item against every run of blocks, with nothing left out before."""
    found = {}
    for key, text in items:
        item = decontaminate._item(key, text)
        n = item.blocks
        for doc, body, *_ in rows:
            words = decontaminate._hashes(body or "")
            for b in range(0, len(words), BLOCK):
                run = words[max(0, b - BLOCK) : b + (n + 1) * BLOCK]
                length = common_words(item.words, run)
                if length < loose * len(item.words):
                    continue
                told = common_words(item.answer, run) >= answer * len(item.answer)
                if told or length >= common * len(item.words):
                    found[(doc, key)] = max(found.get((doc, key), 0), length)
    return found


def test_the_search_without_a_cosine_is_exact(spark):
    rows, items, kinds = _corpus()
    rows += [(1000, "w " * 3000 + items[0][1], None, None), (1001, items[1][1] + " " + items[1][1], None, None)]
    got = decontaminate.find_leaks(table(spark, rows), spark.createDataFrame(items, ITEMS), least_cosine=None)
    want = _brute(rows, items)
    assert {(r.doc_id, r.item_id): r.common for r in got.collect()} == want
    assert sum(kind == 0 for pair, kind in kinds.items() if pair in want) == sum(k == 0 for k in kinds.values())


def test_recall_of_the_cosine_in_each_class(spark):
    rows, items, kinds = _corpus(8, 300)
    bench = spark.createDataFrame(items, ITEMS)
    pairs = {}
    for least in (None, 0.5):
        got = decontaminate.find_leaks(table(spark, rows), bench, least_cosine=least).collect()
        pairs[least] = {(r.doc_id, r.item_id) for r in got}
    assert pairs[0.5] <= pairs[None]
    for kind in range(3):
        exact = {p for p in pairs[None] if kinds.get(p) == kind}
        assert exact and len(exact & pairs[0.5]) >= 0.9 * len(exact)


def test_null_and_repeated_ids_are_judged_by_text(spark):
    _, items, _ = _corpus()
    clean, other = "a clean text of no item at all", "another clean text"
    rows = [(None, items[0][1], "x", None), (None, clean, "x", None), (5, items[1][1], "x", None), (5, clean, "x", None),
            (5, clean, "y", None), (None, None, "x", None), (6, other, "x", None)]
    bench = spark.createDataFrame([(None, items[0][1]), *items[1:], *items[1:3]], ITEMS)
    frame = table(spark, rows).withColumn("_leak", F.lit(1)).withColumn("item_id", F.lit(2))
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(frame, bench).collect()}
    assert found == {(None, None), (5, 1)}
    kept = decontaminate.drop_leaks(frame, bench)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or -1, r.text or "", r.lang) for r in kept.collect()) == sorted(
        [(-1, clean, "x"), (5, clean, "x"), (5, clean, "y"), (-1, "", "x"), (6, other, "x")]
    )


def test_tasks_multiply_like_one_matrix(spark):
    """The space is that of an exact SVD of the weighted rows, up to rotation."""
    rows, items, _ = _corpus()
    texts = table(spark, rows).select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("key"))
    df, total, sampled = decontaminate._statistics(texts.where("text is not null"), 64)
    parsed = [decontaminate._item(*i) for i in items]
    spaces = [decontaminate._space(parsed, sampled, df, total, 16, 4096, 4.0, part, 7) for part in (8, 10_000)]
    grams = [s.table @ s.table.T for s in spaces]
    assert np.abs(grams[0] - grams[1]).max() < 1e-2 * np.abs(grams[1]).max()
    assert sampled.count() == 64


def test_counts_and_space_come_from_all_passages(spark):
    rows, items, _ = _corpus()
    rows = [*rows, *[(2000 + i, f"seldom rare{i:04d} " * 40, None, None) for i in range(200)]]
    texts = table(spark, rows).select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("key"))
    counts, total, corpus = decontaminate._statistics(texts.where("text is not null"), None)
    want, passages = {}, 0
    for _, body, *_ in rows:
        words = decontaminate._hashes(body).view(np.int64).tolist()
        for at in range(0, len(words), 64):
            passages += 1
            for w in set(words[at : at + 64]):
                want[w] = want.get(w, 0) + 1
    assert total == passages and {r.w: r.n for r in counts.collect()} == want
    parsed = [decontaminate._item(*i) for i in items]
    space = decontaminate._space(parsed, corpus, counts, total, 16, 4096, 4.0, 1_536, 7)
    # Every word is in the space, the one-document ones too, with a direction of its passages.
    assert set(space.known[:-1].view(np.int64).tolist()) == set(want)
    assert (np.abs(space.table[:-1]).sum(axis=1) > 0).all()


def test_the_driver_holds_few_tall_matrices(spark):
    """Matrices of all words of a space are added up by tasks; the driver takes them a few rows at a time."""
    rows, items, _ = _corpus(count=20)
    rows += [(2000 + i, " ".join(f"word{i}x{j}" for j in range(600)), None, None) for i in range(40)]
    texts = table(spark, rows).select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("key"))
    counts, total, corpus = decontaminate._statistics(texts.repartition(16), None)
    parsed = [decontaminate._item(*i) for i in items]
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        space = decontaminate._space(parsed, corpus, counts, total, 64, 1 << 15, 4.0, 1_536, 7)
        peak = tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()
    assert len(space.known) > 20_000
    assert peak < 9 * len(space.known) * 72 * 4


def test_words_are_counted_once_a_passage():
    draw = np.random.default_rng(5)
    for parts, words in ((1, 1), (9, 40), (300, 7)):
        part = np.repeat(np.arange(parts), draw.integers(1, 65, parts))
        hashes = draw.integers(0, words, len(part)).astype(np.uint64) << np.uint64(60)
        every, counts = decontaminate._passage_counts(hashes, part)
        want = Counter(w for w, _ in set(zip(hashes.tolist(), part.tolist(), strict=True)))
        assert list(zip(every.tolist(), counts.tolist(), strict=True)) == sorted(want.items())
