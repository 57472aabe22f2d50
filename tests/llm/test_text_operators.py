"""Near duplicates, passages, lines and quality rules against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnlake.llm import arrays, jaccard_join, line_dedup, quality_rules, substring_dedup
from tests.llm.helpers import SCHEMA, components, corpus, shingles, table, words


def passages(rows, window=50):
    """Kept text, words and removed words per document, from a dictionary of all windows."""
    first = {}
    for key, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words(text)
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), key)
    out = []
    for key, text, *_ in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if key is not None and first[tuple(w[i : i + window])] < key:
                gone[i : i + window] = [True] * window
        out.append((key, " ".join(x for x, g in zip(w, gone) if not g), len(w), sum(gone)))
    return sorted(out, key=repr)


def test_words_of_agrees_with_a_regular_expression():
    import pyarrow as pa

    texts = [t for _, t, *_ in corpus()]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    got = []
    for _, data, offsets in arrays.runs([batch.slice(3)], limit=500):
        found = arrays.words_of(data, offsets)
        spell = [bytes(data[a:b]).decode() for a, b in zip(found.starts, found.ends)]
        got += [spell[a:b] for a, b in zip(found.first[:-1], found.first[1:])]
    assert got == [words(t) for t in texts[3:]]


def test_window_hashes_depend_on_the_words_alone():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 63, 50).astype(np.uint64)
    twice = np.concatenate([values, values[:1], values])
    found = arrays.Windows(twice)
    at = np.arange(41)
    a, b = found.hashes(at, at + 10), found.hashes(at + 51, at + 61)
    assert (a == b).all() and len(set(a.tolist())) == 41
    assert found.hashes(np.array([0]), np.array([9]))[0] != a[0]


def test_jaccard_components_match_brute_force(spark):
    rows = corpus()
    sets = {r[0]: shingles(r[1]) for r in rows}
    want = components(sets)
    got = jaccard_join.jaccard_components(table(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {
        i: (len(s), want[i]) for i, s in sets.items()
    }


def test_jaccard_chain_of_near_copies(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(base), None, None))
        base = list(base)
        base[rng.randrange(len(base))] = f"x{i}"
    rng.shuffle(rows)
    sets = {r[0]: shingles(r[1]) for r in rows}
    got = jaccard_join.jaccard_components(table(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == components(sets)


def test_jaccard_edge_rows(spark):
    rows = [(None, "a b c d e f", None, None), (5, "a b c d e f", None, None), (5, "a b c d e f", None, None),
            (9, "A B C D E F", None, None), (3, None, None, None), (4, "", None, None)]
    df = table(spark, rows).withColumnRenamed("lang", "id").withColumnRenamed("source", "prefix")
    got = sorted((tuple(r) for r in jaccard_join.jaccard_components(df).collect()), key=repr)
    assert got == sorted(
        [(None, 2, None), (5, 2, 5), (5, 2, 5), (9, 2, 5), (3, 0, 3), (4, 0, 4)], key=repr
    )
    assert jaccard_join.jaccard_components(table(spark, [])).count() == 0


def test_passages_match_brute_force(spark):
    rows = corpus()
    got = substring_dedup.drop_repeated_passages(table(spark, rows)).collect()
    assert sorted(((r.doc_id, r.text, r.n_words, r.n_removed) for r in got), key=repr) == passages(rows)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)


def test_passages_with_few_words_and_loops(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices("ab", k=rng.randint(0, 60))), None, None) for i in range(40)]
    rows += [(50, "x " * 300, None, None), (51, "x " * 90, None, None), (None, "x " * 90, None, None),
             (50, "x " * 300, None, None), (52, None, None, None)]
    got = substring_dedup.drop_repeated_passages(table(spark, rows), window=6).collect()
    assert sorted(((r.doc_id, r.text, r.n_words, r.n_removed) for r in got), key=repr) == passages(rows, 6)
    assert substring_dedup.drop_repeated_passages(table(spark, [])).count() == 0


def lines(rows, least=20, most=3):
    def key(line):
        bare = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in bare)

    held = {}
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            held.setdefault(key(line), set()).add(i)
    rank = lambda i: (i is not None, i or 0)
    out = []
    for i, text, *_ in rows:
        all_lines = (text or "").split("\n")
        kept = [
            x
            for x in all_lines
            if len(key(x)) < least or len(held[key(x)]) < most or i == max(held[key(x)], key=rank)
        ]
        out.append((i, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("extra", [[], [(1000, "Ähnliche ZEILE mit vielen Zeichen\n x", None, None)] * 2
    + [(i, "\v Ähnliche Zeile mit VIELEN Zeichen\t", None, None) for i in (None, 1001)]])
def test_lines_match_brute_force(spark, extra):
    rows = corpus() + extra
    got = line_dedup.drop_common_lines(table(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == lines(rows)


def test_lines_of_an_empty_table_and_clashing_names(spark):
    assert line_dedup.drop_common_lines(table(spark, [])).count() == 0
    df = table(spark).withColumnRenamed("lang", "id").withColumnRenamed("source", "places")
    assert line_dedup.drop_common_lines(df).count() == df.count()


def quality(text):
    w = words(text)
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    inside = [False] * len(w)
    for places in seen.values():
        for at in places if len(places) > 1 else []:
            inside[at : at + 8] = [True] * 8
    solid = [x for x in (text or "").split("\n") if words(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    n, again = len(w), sum(inside)
    return n, sum(map(len, w)), symbols, len(solid) - len(set(solid)), again, n < 20 or 100 * again > 30 * n


def test_quality_counts_match_brute_force(spark):
    rng = random.Random(9)
    rows = corpus()
    rows += [(900 + i, " ".join(rng.choices(["the", "ab", "#é*"], k=60)), None, None) for i in range(20)]
    rows += [(950, "same words again and then more words here " * 9, None, None)]
    got = quality_rules.judge(table(spark, rows)).collect()
    want = {r[0]: quality(r[1]) for r in rows}
    for r in got:
        found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert found == want[r.doc_id]
        assert not (r.kept and r.base_failed)
        assert r.kept == (not r.base_failed and not r.failed_rules)


def test_quality_verdicts_and_plan(spark, capsys):
    good = "The cat sat on the mat and it was a fine day for all of the people in the town square."
    rows = [(1, good + " Then it rained.", None, None), (2, "%%% $$$ " * 30 + good, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n_words", F.lit("mine"))
    judged = quality_rules.judge(df)
    judged.explain()
    plan = capsys.readouterr().out
    assert not any(word in plan for word in ("Exchange", "Python", "Arrow"))
    assert {r.doc_id: r.kept for r in judged.collect()} == {1: True, 2: False}
    assert quality_rules.judge(spark.createDataFrame([], SCHEMA)).count() == 0
