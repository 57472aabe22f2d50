"""Golden records with their members: no exchange, sorted lists, pages, tables named again."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tarnlake.operators.matching import RECORD_ID
from tarnlake.sources import bucketed


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("golden"))
    ids = spark.range(6000).select(
        F.concat(F.lit("r"), F.lpad("id", 5, "0")).alias(RECORD_ID),
        F.when(F.col("id") % 3 == 0, "gid-hot").otherwise(F.concat(F.lit("gid-"), F.col("id") % 50)).alias("golden_id"),
        F.lit("more").alias("cluster"),
    )
    golden = ids.groupBy("golden_id").agg(F.count(F.lit(1)).alias("n")).unionByName(
        spark.createDataFrame([("gid-none", 0)], "golden_id string, n long")
    )
    bucketed.publish_members(golden, ids.repartition(5), path, "run-1", 8)
    want = {}
    for r in ids.collect():
        want.setdefault(r.golden_id, []).append(r[RECORD_ID])
    return path, {k: sorted(v) for k, v in want.items()}


def test_members_are_joined_in_their_buckets(spark, published):
    path, want = published
    df = bucketed.golden_with_members(spark, path, "run-1")
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    got = {r.golden_id: (r.n, r.contributing_source_records) for r in df.collect()}
    assert got.pop("gid-none") == (0, None)
    assert got == {k: (len(v), v) for k, v in want.items()}


def test_pages_of_a_hot_cluster(spark, published):
    path, want = published
    page, after = [], None
    while rows := bucketed.member_page(spark, path, "run-1", "gid-hot", 900, after).collect():
        page += [r[RECORD_ID] for r in rows]
        after = page[-1]
    assert page == want["gid-hot"]
    one = bucketed.member_page(spark, path, "run-1", "gid-1", 5)
    assert "EqualTo(golden_id,gid-1)" in one._jdf.queryExecution().executedPlan().toString()


def test_a_table_is_named_again_from_its_path(spark, published):
    path, want = published
    spark.sql(f"DROP TABLE {bucketed._name(path + '/members-run-1')}")
    rows = bucketed.read_bucketed(spark, f"{path}/members-run-1")
    assert rows.count() == sum(map(len, want.values()))
    assert "Exchange" not in bucketed.golden_with_members(spark, path, "run-1")._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(FileNotFoundError):
        bucketed.read_bucketed(spark, f"{path}/members-run-2")


def test_publishing_again_replaces_the_run(spark, tmp_path):
    for n in (3, 2):
        rows = spark.range(n).select(F.col("id").cast("string").alias(RECORD_ID), F.lit("g").alias("golden_id"))
        bucketed.publish_members(rows.select("golden_id").distinct(), rows, str(tmp_path / "g"), "r", 2)
    got = bucketed.golden_with_members(spark, str(tmp_path / "g"), "r").collect()
    assert [r.contributing_source_records for r in got] == [["0", "1"]]
