from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tarnlake import session
from tarnlake.operators.scope import ScopeFilter
from tarnlake.sources import layers, sinks
from tarnlake.streaming import events


def test_raw_is_text_and_append_only(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = spark.createDataFrame([(1, True, None), (2, False, 1.5)], "a int, b boolean, c double")
    assert sinks.write_raw(df, path, "2024-01-01", "r1") == 2
    assert sinks.write_raw(df.drop("c").withColumn("d", F.lit("x")), path, "2024-01-01", "r2") == 2
    got = layers.read_layer(spark, path, merge_schema=True)
    assert {f.name: f.dataType.typeName() for f in got.schema.fields if f.name in "abcd"} == dict.fromkeys("abcd", "string")
    assert got.count() == 4 and got.where("c IS NULL").count() == 3
    assert sinks.write_raw(df.limit(0), path, "2024-01-02", "r3") == 0


def test_raw_files_can_follow_the_watermark(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = spark.range(0, 1000, 1, 8).selectExpr("id", "(id * 7919) % 1000 AS w")
    assert sinks.write_raw(df, path, "2024-01-01", "r", rows_per_file=100, order_by="w") == 1000
    per_file = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(
        F.min(F.col("w").cast("int")).alias("lo"), F.max(F.col("w").cast("int")).alias("hi"), F.count(F.lit(1)).alias("n")
    )
    files = sorted((r.lo, r.hi, r.n) for r in per_file.collect())
    assert all(a[1] < b[0] for a, b in zip(files, files[1:])) and max(f[2] for f in files) <= 100


def test_latest_run_of_nothing(spark, tmp_path):
    assert layers.latest_curated(spark, str(tmp_path / "none")) is None
    (tmp_path / "empty").mkdir()
    assert layers.latest_analytics(spark, str(tmp_path / "empty")) is None


def test_latest_run_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "cur")
    for day, run in ((1, "z"), (2, "a"), (2, "b")):
        sinks.write_curated(spark.range(day), path, date(2024, 1, day), run)
    got = layers.latest_curated(spark, path)
    assert {(str(r.curated_date), r.run_id) for r in got.collect()} == {("2024-01-02", "b")}
    assert all("curated_date=2024-01-02/run_id=b" in f for f in got.inputFiles())


def test_empty_layers_are_refused(spark, tmp_path):
    with pytest.raises(sinks.EmptyWrite):
        sinks.write_curated(spark.range(0), str(tmp_path / "a"), date(2024, 1, 1), "r")
    with pytest.raises(sinks.EmptyWrite):
        sinks.publish_analytics(spark.range(0), str(tmp_path / "b"), date(2024, 1, 1))
    assert sinks.write_curated(spark.range(0), str(tmp_path / "c"), date(2024, 1, 1), "r", allow_empty=True) == 0


def test_publish_golden(spark, tmp_path):
    path = str(tmp_path / "g")
    golden = spark.createDataFrame([("g", ["a", "b"], {"x": "s"})], "golden_id string, contributing_source_records array<string>, field_provenance map<string,string>")
    links = spark.createDataFrame([("a", "b", ["f"])], "record_a_id string, record_b_id string, matched_fields array<string>")
    members = spark.createDataFrame([("a", "g"), ("b", "g")], "_record_id string, golden_id string")
    assert sinks.publish_golden(golden, links, members, path, date(2024, 1, 1), "run-1") == 1
    row = spark.read.parquet(f"{path}/golden").first()
    assert (row.contributing_source_records, row.field_provenance) == ('["a","b"]', '{"x":"s"}')
    assert spark.read.parquet(f"{path}/decisions").count() == 1
    assert spark.read.parquet(f"{path}/membership").count() == 2


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_export_filters_itself(spark, tmp_path, fmt):
    df = spark.createDataFrame([("u1", 1), ("u2", 2), (None, 3)], "scope_unit_id string, v int")
    path = str(tmp_path / fmt)
    assert sinks.export(df, path, fmt, ScopeFilter(("u1",))) == 1
    with pytest.raises(ValueError):
        sinks.export(df.drop("scope_unit_id"), path + "x", fmt, ScopeFilter(("u1",)))
    with pytest.raises(ValueError):
        sinks.export(df, path + "y", "xml", ScopeFilter(None))


def test_bulk_csv_count(spark, tmp_path):
    path = str(tmp_path / "csv")
    spark.range(5).write.option("header", "true").csv(path)
    assert layers.read_bulk_csv(spark, path, "id long", 5).count() == 5
    with pytest.raises(layers.RowCountMismatch):
        layers.read_bulk_csv(spark, path, "id long", 6)


def test_nested_json_without_unwrap(spark, tmp_path):
    (tmp_path / "page.json").write_text('{"data": {"items": [{"id": 1}, {"id": 2}]}}\n{"data": {}}\n')
    got = layers.read_nested_json(spark, str(tmp_path), "data.items", "data struct<items:array<struct<id:int>>>")
    assert sorted(r.id for r in got.collect()) == [1, 2]


def test_field_modes(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b", "x__c"])
    custom = ("x__c",)
    assert layers.select_fields(df).columns == ["a", "b", "x__c"]
    assert layers.select_fields(df, "standard", custom=custom).columns == ["a", "b"]
    assert layers.select_fields(df, "custom", custom=custom).columns == ["x__c"]
    assert layers.select_fields(df, "includeOnly", include=("b", "x__c"), exclude=("x__c",)).columns == ["b"]
    with pytest.raises(ValueError):
        layers.select_fields(df, "includeOnly", include=("zz",))


def test_watermark_predicates_cover_the_window_once():
    got = layers.watermark_predicates("m", "2024-01-01", "2024-01-04", ["2024-01-03", "2024-01-02", "2025-01-01"])
    assert got == [
        "m >= '2024-01-01' AND m < '2024-01-02'", "m >= '2024-01-02' AND m < '2024-01-03'", "m >= '2024-01-03' AND m < '2024-01-04'",
    ]
    with pytest.raises(ValueError):
        layers.watermark_predicates("m", "2024-01-01' OR 1=1 --", "2024-01-04")


def test_sql_inputs_are_named_safely(spark):
    with pytest.raises(ValueError):
        layers.run_sql(spark, "SELECT 1", {"a; DROP": spark.range(1)})
    got = layers.run_sql(spark, "SELECT count(*) AS n FROM v WHERE id < :top", {"v": spark.range(9)}, {"top": 4})
    assert got.first().n == 4


def test_serving_load_replaces_only_changed_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    v1 = spark.createDataFrame([(k, f"v{k}", False) for k in range(300)], "k int, v string, gone boolean")
    assert sinks.load_serving(spark, path, v1, ["k"], ["k", "v"], "gone", 1 << 10).delta_rows == 300
    v2 = spark.createDataFrame([(2, "B", False), (3, "v3", False), (300, "c", False), (5, "v5", True)], v1.schema)
    done = sinks.load_serving(spark, path, v2, ["k"], ["k", "v"], "gone", 1 << 10)
    assert done.delta_rows == 3 and done.buckets <= 3
    got = {r.k: r.v for r in sinks.read_serving(spark, path, ["k"]).collect()}
    assert got == {k: f"v{k}" for k in range(300) if k != 5} | {2: "B", 300: "c"}
    assert sinks.load_serving(spark, path, v2.where("k < 4"), ["k"], ["k", "v"], "gone", 1 << 10).buckets == 0


def test_shared_folder_comes_from_the_session(spark):
    assert session.work_path(spark, "x").startswith(session.shared_base(spark))
    assert session.shared_base(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


# ------------------------------------------------------------------ streams

EVENT = "tenant_code string, connection_id string, source_id string, body string, ts timestamp"


def put(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).selectExpr("* EXCEPT (ts)", "cast(ts AS timestamp) AS ts").write.mode(
        "append"
    ).parquet(path)


def test_duplicates_across_batches(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "tenant_code string, connection_id string, source_id string, body string, ts string"

    def drain():
        stream = events.read_files(spark, source, EVENT)
        events.append_available(events.dedupe(events.identify(stream), "ts"), target, mark)
        return spark.read.parquet(target)

    a = '{"id":"1","type":"Deal.Created"}'
    put(spark, source, [("t", "c", "crm", a, "2024-01-01 10:00:00"), ("t", "c", "crm", a, "2024-01-01 10:05:00")], schema)
    assert drain().count() == 1
    put(spark, source, [("t", "c", "crm", a, "2024-01-02 10:00:00"), ("t", "d", "crm", a, "2024-01-02 10:00:00")], schema)
    got = drain()
    assert got.count() == 2 and {r.entity_id for r in got.collect()} == {"crm-deal-created"}


def test_event_without_id_or_type(spark):
    import hashlib

    df = spark.createDataFrame([("t", "c", "crm", '{"x":1}'), ("t", "c", "crm", '{"type":"?!"}')], "tenant_code string, connection_id string, source_id string, body string")
    got = events.identify(df).collect()
    assert got[0].event_id == hashlib.sha256(b'{"x":1}').hexdigest()
    assert {r.entity_id for r in got} == {"crm-webhook"}
    key = "whk-" + hashlib.sha256(f"t:c:{got[0].event_id}".encode()).hexdigest()[:24]
    assert got[0].event_key == key


def test_change_log_is_idempotent_and_ordered(spark, tmp_path, rows):
    path = str(tmp_path / "log")
    apply = events.log_changes(path, ["k"], ["n"])
    first = spark.createDataFrame([("a", 1, "x", False), ("a", 2, "y", False), ("b", 1, "z", False), (None, 1, "q", False)], "k string, n int, v string, gone boolean")
    second = spark.createDataFrame([("b", 2, "z", True), ("a", 1, "late", False)], "k string, n int, v string, gone boolean")
    for batch, number in ((first, 0), (first, 0), (second, 1), (second, 1)):
        apply(batch, number)
    log = spark.read.parquet(path)
    assert log.count() == 4
    base = spark.createDataFrame([("b", 0, "old", False), ("c", 0, "kept", False)], "k string, n int, v string, gone boolean")
    state = events.current_from_log(log, ["k"], ["n"], "gone", base)
    assert rows(state.select("k", "v")) == [("a", "y"), ("c", "kept")]


def test_cdc_over_several_batches(spark, tmp_path, rows):
    source, log, mark = (str(tmp_path / n) for n in ("in", "log", "mark"))
    schema = "k string, v string, ts string"
    for part in ([("a", "1", "2024-01-01 00:00:00"), ("b", "1", "2024-01-01 00:00:00")], [("a", "2", "2024-01-02 00:00:00")]):
        put(spark, source, part, schema)
    stream = events.read_files(spark, source, "k string, v string, ts timestamp", files_per_trigger=1)
    events.apply_available(stream, mark, events.log_changes(log, ["k"], ["ts"]))
    assert spark.read.parquet(log).select("batch_id").distinct().count() == 2
    assert rows(events.current_from_log(spark.read.parquet(log), ["k"], ["ts"]).select("k", "v")) == [("a", "2"), ("b", "1")]


def test_late_events_are_left_out_of_closed_windows(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "k string, ts string"
    for ts in ("2024-01-01 05:00:00", "2024-01-03 05:00:00", "2024-01-01 06:00:00", "2024-01-09 00:00:00"):
        put(spark, source, [("a", ts)], schema)
        stream = events.read_files(spark, source, "k string, ts timestamp")
        daily = events.tumbling(stream, "ts", "1 day", ["k"], [F.count(F.lit(1)).alias("n")], "1 hour")
        events.append_available(daily, target, mark)
    got = spark.read.parquet(target).collect()
    assert sorted((r.window_start.date().isoformat(), r.n) for r in got) == [("2024-01-01", 1), ("2024-01-03", 1)]
