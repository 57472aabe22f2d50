"""Behaviour past former limits: sizes, nulls, late events, untouched files, workers elsewhere."""

from __future__ import annotations

import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from tarnlake.operators import incremental, matching, quality, scope
from tarnlake.sources import layers, sinks
from tarnlake.streaming import events
from tests.conftest import ROOT, SMALL


def test_scope_chain_diamond_and_cycle(spark):
    rows = [(f"u{i}", f"u{i - 1}") for i in range(70)] + [("u9", "u7"), ("u0", "u69"), ("x", None), (None, "u3")]
    units = spark.createDataFrame(rows, "scope_unit_id string, parent_scope_unit_id string").coalesce(1)
    grants = spark.createDataFrame([("u2",), ("u2",)], "scope_unit_id string")
    got = [r[0] for r in scope.expand_grants(grants, units).collect()]
    assert sorted(got) == sorted(f"u{i}" for i in range(70))


def test_granted_table_filters_without_a_list(spark):
    units = spark.createDataFrame([("a", None), ("b", "a")], "scope_unit_id string, parent_scope_unit_id string")
    grants = spark.createDataFrame([("a",)], "scope_unit_id string")
    data = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "scope_unit_id string, n int")
    assert sorted(r.n for r in scope.granted_filter(grants, units).apply(data).collect()) == [1, 2]
    with pytest.raises(scope.UnknownUnit):
        scope.granted_filter(grants.withColumn("scope_unit_id", F.lit("zz")), units)


def test_no_block_limit_unless_asked_for():
    config = {
        "entity_type": "person",
        "rule_set_version": "1",
        "rules": [{"rule_id": "r", "strategy": "deterministic", "fields": [{"field_name": "email"}]}],
        "blocking": {"key_type": "email_domain", "source_field": "email"},
    }
    assert matching.rules_from_config(config).blocking.max_block_size is None


def test_cut_blocks_are_reported(spark):
    df = spark.sql("SELECT cast(id AS string) AS _record_id, if(id < 30, 'a', 'b') AS k FROM range(35)")
    row = matching.cut_block_report(df, "k", 10).first()
    assert (row.cut_blocks, row.records_in_cut_blocks) == (1, 30)


@pytest.mark.parametrize("limit", [5, 8, 50, 89, 90, 93, 100, 200])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_capped_read_with_null_watermarks(spark, limit, kind):
    df = spark.sql(
        f"SELECT id, cast(if(id % 10 = 0, NULL, timestamp_seconds(1700000000 + id * 9000)) AS {kind}) AS ts FROM range(100)"
    )
    got, more = incremental.capped_read(df, "ts", limit, ["id"])
    want = [r.id for r in df.orderBy(F.col("ts").asc_nulls_last(), "id").limit(limit).collect()]
    assert sorted(r.id for r in got.collect()) == sorted(want)
    assert more == (limit < 100)


def test_capped_read_filter_reaches_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    spark.sql("SELECT id, timestamp_seconds(1700000000 + id * 9000) AS ts FROM range(100)").write.parquet(path)
    got, _ = incremental.capped_read(spark.read.parquet(path), "ts", 40, ["id"])
    got.explain("formatted")
    assert "LessThan(ts" in capsys.readouterr().out


def test_throughput_must_be_positive(spark):
    df = spark.sql("SELECT 0.0D AS rate, 100.0D AS per_day")
    with pytest.raises(Exception, match="throughput"):
        df.select(incremental.chunk_days(F.col("rate"), F.col("per_day"))).collect()


def test_late_first_deliveries_are_kept(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "tenant_code string, connection_id string, source_id string, body string, ts timestamp"
    sent = [("a", "2024-01-11"), ("z", "2024-01-12"), ("b", "2024-01-01"), ("a", "2024-01-11"), ("y", "2024-01-13")]
    for name, day in sent:
        row = spark.createDataFrame([("t", "c", "s", f'{{"id":"{name}"}}', f"{day} 00:00:00")], schema.replace("timestamp", "string"))
        row.selectExpr("* EXCEPT (ts)", "cast(ts AS timestamp) AS ts").coalesce(1).write.mode("append").parquet(source)
        stream = events.read_files(spark, source, schema)
        events.append_available(events.dedupe(events.received(events.identify(stream))), target, mark)
    assert sorted(r.event_id for r in spark.read.parquet(target).collect()) == ["a", "b", "y", "z"]


def test_exception_sample_is_ordered(spark):
    df = spark.sql("SELECT 9 - id AS k, 'f' AS field_name, 'c' AS check_kind FROM range(10)")
    assert [r.k for r in quality.exception_sample(df, ["k"], 3).collect()] == [0, 1, 2]


def test_empty_writes_are_refused_and_harmless(spark, tmp_path):
    from datetime import date

    path = str(tmp_path / "c")
    df = spark.createDataFrame([(1,)], "n int")
    assert sinks.write_curated(df, path, date(2024, 1, 1), "r") == 1
    with pytest.raises(sinks.EmptyWrite):
        sinks.write_curated(df.where("n > 1"), path, date(2024, 1, 1), "r")
    assert spark.read.parquet(path).count() == 1


def test_bulk_load_statements():
    given = ("sales", "stage", ["id"], {"id": "BIGINT", "v": "VARCHAR(20)"}, "s3://b/p/run=1/", "arn:aws:iam::1:role/copy")
    create, copy, drop, merge = sinks.bulk_load_statements(*given)
    assert create == "CREATE TEMP TABLE stage (id BIGINT, v VARCHAR(20), _row_hash VARCHAR(64))"
    assert copy == "COPY stage (id, v, _row_hash) FROM 's3://b/p/run=1/' IAM_ROLE 'arn:aws:iam::1:role/copy' FORMAT AS PARQUET"
    assert drop == "DELETE FROM stage USING sales WHERE sales.id = stage.id AND sales._row_hash = stage._row_hash"
    assert merge == (
        "MERGE INTO sales USING stage ON sales.id = stage.id WHEN MATCHED THEN UPDATE SET v = stage.v, "
        "_row_hash = stage._row_hash WHEN NOT MATCHED THEN INSERT (id, v, _row_hash) VALUES (stage.id, stage.v, stage._row_hash)"
    )
    for place, bad in ((0, "s; x"), (2, ["z"]), (3, {"id": "INT; DROP"}), (4, "s3://b/p'/"), (5, "role'")):
        with pytest.raises(ValueError):
            sinks.bulk_load_statements(*given[:place], bad, *given[place + 1 :])


def test_merge_statements():
    made = {d: sinks.jdbc_merge_statement("t", "s", ["id"], ["id", "v"], d) for d in ("mysql", "postgresql", "sqlserver")}
    assert made["mysql"] == "INSERT INTO t (id, v) SELECT id, v FROM s ON DUPLICATE KEY UPDATE v = VALUES(v)"
    assert made["postgresql"].endswith("ON CONFLICT (id) DO UPDATE SET v = EXCLUDED.v")
    assert made["sqlserver"].startswith("MERGE INTO t AS t USING s AS s ON t.id = s.id WHEN MATCHED")
    for bad in (("t;", "s", ["id"], ["id"], "mysql"), ("t", "s", [], ["id"], "mysql"), ("t", "s", ["id"], ["id"], "x")):
        with pytest.raises(ValueError):
            sinks.jdbc_merge_statement(*bad)
    predicates = layers.watermark_predicates("m", "2024-01-01", "2024-01-03", ["2024-01-02"])
    assert predicates == ["m >= '2024-01-01' AND m < '2024-01-02'", "m >= '2024-01-02' AND m < '2024-01-03'"]


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_python_steps_run_where_the_package_is_not_installed(tmp_path):
    code = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        ".config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        "from __spark_entry__ import queries\n"
        "print('rows', queries()['er_jaro_winkler'](spark, sys.argv[2]).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code, ROOT, SMALL], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split("rows")[-1]) > 0


def test_backfill_of_a_long_busy_window_plans_every_chunk(spark, tmp_path):
    from __spark_entry__ import queries

    spark.range(1_300_000).selectExpr(
        "'O' AS o_orderstatus", "timestamp_ntz'1992-01-01 00:00:00' + make_dt_interval(cast(id % 2400 AS int)) AS o_orderdate"
    ).write.parquet(str(tmp_path / "orders.parquet"))
    got = queries()["backfill_chunks"](spark, str(tmp_path))
    total = got.agg(F.count(F.lit(1)), F.min("chunk_days"), F.max("chunk_days"), F.sum("rows")).first()
    assert tuple(total) == (2400, 1, 1, 1_300_000)
