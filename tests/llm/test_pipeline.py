"""Every pipeline stage against a brute-force version on a small corpus."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import components, shingles, vocabulary, words


def _rows():
    rng = random.Random(77)
    vocab = {k: ["".join(rng.choices(a, k=rng.randint(3, 7))) for _ in range(600)]
             for k, a in {"en": "abcdefghi", "fr": "qrstuvwxyzé"}.items()}
    items = [(i, " ".join(rng.choices(vocab["en"], k=rng.randint(15, 40)))) for i in range(8)]
    rows, leaked = [], set()
    for i in range(160):
        lang = "en" if i % 3 else "fr"
        body = rng.choices(vocab[lang], k=rng.randint(30, 200))
        if i % 20 == 1:
            at = rng.randint(0, len(body))
            body[at:at] = items[i % 8][1].split()
            leaked.add(i)
        rows.append((i, " ".join(body), lang, ["a", "b", "c", None][i % 4 if i < 100 else 0], 1))
    for i in range(0, 60, 4):
        rows.append((200 + i, rows[i][1], rows[i][2], "b", 1))
        near = rows[i][1].split()
        near[rng.randrange(len(near))] = "other"
        rows.append((300 + i, " ".join(near), rows[i][2], "c", 1))
    rows += [(900, None, "en", "a", 0), (901, "12 34", "en", "a", 5), (902, "", None, "b", 0)]
    return rows, items, leaked


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    rows, items, leaked = _rows()
    folder = str(tmp_path_factory.mktemp("corpus"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, tables = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        tables.append(docs)
    return folder, rows, leaked, tables


def test_stages_are_the_dealt_ones(chain):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "jaccard_join", "decontaminate", "source_mix", "token_store",
    ]
    for table in chain[3][:-1]:
        assert table.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_stage(chain):
    _, rows, _, tables = chain
    kept = {r.doc_id for r in tables[0].collect()}
    assert kept == {r[0] for r in rows} - {900, 901, 902}


def test_near_duplicate_stage(chain):
    tables = chain[3]
    before = {r.doc_id: r.text for r in tables[0].collect()}
    root = components({i: shingles(t) for i, t in before.items()})
    assert {r.doc_id: r.text for r in tables[1].collect()} == {
        i: t for i, t in before.items() if root[i] == i
    }


def test_leak_stage(chain):
    _, _, leaked, tables = chain
    before = {r.doc_id for r in tables[1].collect()}
    assert {r.doc_id for r in tables[2].collect()} == before - leaked


def test_mix_stage(chain):
    tables = chain[3]
    before = {r.doc_id: (r.source, r.text) for r in tables[2].collect()}
    after = tables[3].collect()
    assert all(before[r.doc_id] == (r.source, r.text) for r in after)
    copies = Counter(r.doc_id for r in after)
    assert max(copies.values()) <= 3
    sizes = Counter()
    for source, text in before.values():
        sizes[source] += len(words(text))
    taken = Counter()
    for r in after:
        taken[r.source] += len(words(r.text))
    weight = {s: [1, 2, 3][i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    total, level = sum(sizes.values()), 0.0
    lo, hi = 0.0, 10.0 * total
    for _ in range(100):
        level = (lo + hi) / 2
        filled = sum(min(3 * sizes[s], level * weight[s]) for s in sizes)
        lo, hi = (level, hi) if filled < total else (lo, level)
    longest = max(len(words(t)) for _, t in before.values())
    for s in sizes:
        assert abs(taken[s] - min(3 * sizes[s], level * weight[s])) <= longest / 2 + 1


def test_token_stage(chain, spark):
    from tokenizers import Tokenizer

    from tarnlake.llm.queries import tokenizer_path

    tables = chain[3]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want, start = [], 0
    for key, text in sorted((r.doc_id, r.text) for r in tables[3].collect()):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        want.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, tables[4].collect()), key=lambda r: r[1]) == want


def test_run_gives_the_last_stage(chain, spark):
    folder, _, _, tables = chain
    again = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, tables[4].collect()))
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_and_extra_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, id string, score double"
    folder = str(tmp_path)
    spark.createDataFrame([], schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "some words of an item here")], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    assert corpus_pipeline.run(spark, folder).count() == 0
    rows = [(i, f"word{i} and more words of text {i}", "en", "s", 1, "x", 0.5) for i in range(30)]
    docs = spark.createDataFrame([*rows, (None, "letters", "en", None, None, None, None)], schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == schema.replace(",", "").split()[::2]
    assert docs.where(F.col("id") == "x").count() > 0
