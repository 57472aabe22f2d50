"""The registered queries against their check SQL, and their shapes where SQL can't tell."""

from __future__ import annotations

import os

import pytest

from tests.conftest import SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def checker():
    import check_queries

    return check_queries, check_queries.connect(SMALL)


def _names():
    from tarnlake.llm.queries import ORACLE_SQL

    return sorted(ORACLE_SQL)


@pytest.mark.parametrize("name", _names())
def test_query(name, spark, checker):
    from __spark_entry__ import oracle_sql, queries

    module, con = checker
    assert module.compare(queries()[name](spark, SMALL), con, oracle_sql()[name]) == ""


def test_one_query_for_each_operator():
    from __spark_entry__ import queries

    names = [n for n in queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in queries()


def test_token_query_against_the_tokenizer(spark):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    from tarnlake.llm import queries

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want, start = [], 0
    for key, text in sorted(rows):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = queries.op3_token_store(spark, SMALL).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == want


def test_leak_query_finds_every_contained_item(spark):
    from tarnlake.llm import queries
    from tests.llm.helpers import lowered, words

    items = [(r.item_id, f" {' '.join(words(lowered(r.text)))} ")
             for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    held = {(i, k) for i, t in texts for k, item in items if item in f" {' '.join(words(lowered(t)))} "}
    got = {(r.doc_id, r.item_id) for r in queries.op4_decontaminate(spark, SMALL).collect()}
    assert held <= got and len(got) <= len(held) + 2


def test_url_query_keeps_to_the_rules(spark):
    from tarnlake.llm import queries

    rows = queries.op5_url_templates(spark, SMALL).collect()
    verdicts = {r.place: r.verdict for r in queries.URL_RULES}
    assert len(rows) == spark.read.parquet(f"{SMALL}/pages.parquet").count()
    for r in rows:
        fits = [
            p
            for p in verdicts
            if (r.host == p.split("/")[0] or r.host.endswith("." + p.split("/")[0]))
            and r.path.startswith(p[p.index("/") :])
        ]
        best = max(fits, key=len, default=None)
        assert r.rule == best and (best is None or r.verdict == verdicts[best])
        assert r.verdict in ("allow", "block")


def test_language_query_on_held_out_documents(spark):
    from tarnlake.llm import queries

    labels = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op7_language_id(spark, SMALL).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(labels) and held
    assert sum(r.lang_pred == labels[r.doc_id] for r in held) >= 0.95 * len(held)
