"""Rows that are equal, share an id, or have none, in mixing and in the pipeline's near duplicates."""

from __future__ import annotations

import os
from collections import Counter

import corpus_pipeline
from tarnlake import session
from tarnlake.llm import source_mix

SCHEMA = "doc_id long, text string, lang string, source string, copies int"


def test_six_equal_rows_against_a_target_of_a_third(spark):
    rows = [(1, "w " * 10, "en", "a", 1)] * 6 + [(10 + i, "v " * 10, "en", "b", 1) for i in range(2)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    plan = source_mix.mix_plan(docs, weights=(1, 3))
    wanted = Counter({"a": 0, "b": 0})
    for r in plan.collect():
        wanted[r.source] += r.copies
    assert wanted["a"] == 2
    got = Counter(r.source for r in source_mix.mix_sources(docs, weights=(1, 3)).collect())
    assert got == wanted


def test_equal_rows_that_differ_elsewhere(spark):
    rows = [(1, "w " * 10, "en", "a", i) for i in range(4)] + [(1, "w " * 10, "en", "a", 9)] * 3 + [(2, "v v", None, None, 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    mixed = source_mix.mix_sources(docs).collect()
    assert sum(r.copies for r in source_mix.mix_plan(docs).collect()) == len(mixed)
    assert mixed == source_mix.mix_sources(docs).collect() or Counter(mixed) == Counter(source_mix.mix_sources(docs).collect())
    assert {tuple(r) for r in mixed} <= set(rows)


def test_near_duplicates_with_shared_and_missing_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = a.replace("a59", "z")
    rows = [
        (5, a, "en", "s", 1), (5, b, "en", "s", 1), (None, near, "en", "s", 1), (None, c, "fr", "s", 1),
        (7, b, "en", "s", 1), (9, c, "en", "t", 2), (9, c, "en", "s", 2), (None, None, "en", "s", 0), (None, None, "en", "s", 0),
        (3, "", "en", "s", 0), (4, "", "en", "s", 0),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    kept = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert sorted(kept, key=repr) == sorted(
        [(5, a, "en", "s", 1), (5, b, "en", "s", 1), (9, c, "en", "s", 2), (None, None, "en", "s", 0),
         (3, "", "en", "s", 0), (4, "", "en", "s", 0)], key=repr)


def test_the_pipeline_leaves_its_stages_only(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"{text} own{i} " + "xyzabc "[i % 3 :] * i, "en", "a", 1) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "not in any document at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    before = set(os.listdir(session.shared_base(spark).removeprefix("file://")))
    corpus_pipeline.run(spark, str(tmp_path)).count()
    left = set(os.listdir(session.shared_base(spark).removeprefix("file://"))) - before
    assert {n.rsplit("-", 1)[0] for n in left} <= {n for n, _ in corpus_pipeline.STAGES} | {"tokens"}
