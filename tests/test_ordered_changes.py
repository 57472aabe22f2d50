"""Ordered change apply over five deliveries, and the expiry of its state."""

from __future__ import annotations

import subprocess
import sys
from datetime import datetime, timedelta

from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.session import STATE_STORE_CONF
from tarnlake.sources.keyed_layer import KeyedLayer
from tarnlake.streaming import events, ordered
from tests.conftest import SMALL

SCHEMA = "id string, at timestamp, version int, value string, gone boolean"
START = datetime(2024, 1, 1)


def _at(minutes):
    return START + timedelta(minutes=minutes)


def _run(spark, tmp_path, deliveries, late="1 hour"):
    """Applies the deliveries one by one; the rows of the layer after each, and what got through."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "passed", "checkpoint"))
    layer = KeyedLayer(spark, str(tmp_path / "layer"), ["id"])
    merge = ordered.apply_ordered(layer, ["at", "version"], "gone")
    states = []

    def apply(batch, batch_id):
        kept = batch.persist()
        kept.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(out)
        merge(kept, batch_id)
        kept.unpersist()

    for rows in deliveries:
        spark.createDataFrame([(i, _at(m), v, x, g) for i, m, v, x, g in rows], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        changes = events.read_files(spark, source, spark.createDataFrame([], SCHEMA).schema)
        events.apply_available(ordered.newer_only(changes, ["id"], ["at", "version"], late), checkpoint, apply)
        held = layer.read()
        states.append({} if held is None else {r.id: (r.version, r.value) for r in held.collect()})
    passed = [(r.id, r.version, r.value) for r in spark.read.parquet(out).collect()]
    return states, passed


def test_five_deliveries_out_of_order_and_repeated(spark, tmp_path):
    states, passed = _run(
        spark,
        tmp_path,
        [
            [("a", 10, 1, "a1", False), ("b", 10, 1, "b1", False), ("", 10, 1, "no key", False)],
            [("a", 5, 0, "a0", False), ("a", 10, 1, "a1", False), ("b", 12, 2, "b2", False), ("b", 11, 1, "b1b", False)],
            [("b", 20, 3, None, True), ("c", 20, 1, "c1", False)],
            [("b", 15, 2, "b back", False), ("c", 20, 0, "c0", False), ("c", 20, 2, "c2", False)],
            [("b", 20, 3, None, True), ("a", 30, 5, "a5", False), ("b", 10, 1, "b1", False)],
        ],
    )
    assert states[0] == {"a": (1, "a1"), "b": (1, "b1")}
    assert states[1] == {"a": (1, "a1"), "b": (2, "b2")}
    assert states[2] == {"a": (1, "a1"), "c": (1, "c1")}
    assert states[3] == {"a": (1, "a1"), "c": (2, "c2")}
    assert states[4] == {"a": (5, "a5"), "c": (2, "c2")}
    assert sorted(passed, key=repr) == sorted(
        [("a", 1, "a1"), ("b", 1, "b1"), ("b", 2, "b2"), ("b", 3, None), ("c", 1, "c1"), ("c", 2, "c2"), ("a", 5, "a5")],
        key=repr,
    )


def test_state_expires_and_a_deletion_stays(spark, tmp_path):
    states, passed = _run(
        spark,
        tmp_path,
        [
            [("a", 0, 1, "a1", False), ("b", 0, 1, "b1", False)],
            [("a", 1, 2, None, True)],
            [("z", 300, 1, "z1", False)],
            [("z", 301, 2, "z2", False)],
            # The state of a and b is gone; what is older than the bound no longer counts.
            [("a", 0, 1, "a1", False), ("b", 302, 2, "b2", False)],
        ],
    )
    assert states[4] == {"b": (2, "b2"), "z": (2, "z2")}
    assert ("a", 1, "a1") in passed and passed.count(("a", 1, "a1")) == 1
    rows = spark.read.format("statestore").option("path", str(tmp_path / "checkpoint")).option("stateVarName", "seen").load()
    left = {r.key.id for r in rows.select("key").collect()}
    assert left == {"b", "z"}


def test_processor_starts_in_a_worker_without_the_package(tmp_path):
    processor = ordered.NewerOnly([T.StructField("at", T.TimestampType())], ["id", "at"])
    code = """if True:
        import importlib.util, pickle, sys
        assert importlib.util.find_spec("tarnlake") is None
        made = pickle.load(sys.stdin.buffer)
        print(made.inputs, made.handleInputRows.__globals__["_place"]((None, 1)))
    """
    done = subprocess.run(
        [sys.executable, "-c", code],
        input=cloudpickle.dumps(processor),
        cwd=tmp_path,
        env={"PATH": "/usr/bin:/bin"},
        capture_output=True,
        timeout=120,
    )
    assert done.returncode == 0, done.stderr.decode()
    assert done.stdout.decode().strip() == "['id', 'at', '_tie'] ((False, None), (True, 1))"


def test_a_session_with_the_default_state_store(spark, tmp_path):
    """The state has values and timers, which Spark's default store can't hold."""
    rows = [("a", _at(2), 2, "a2", False), ("a", _at(1), 1, "a1", False), ("b", _at(1), 1, None, True), (None, _at(1), 1, "x", False)]
    source = str(tmp_path / "in")
    spark.createDataFrame(rows, SCHEMA).write.parquet(source)
    changes = events.read_files(spark, source, spark.createDataFrame([], SCHEMA).schema)
    layer = KeyedLayer(spark, str(tmp_path / "layer"), ["id"])
    before = spark.conf.get(STATE_STORE_CONF)
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    try:
        spark.conf.set(STATE_STORE_CONF, default)
        newer = ordered.newer_only(changes, ["id"], ["at", "version"], "1 hour")
        ordered.run_available(newer, str(tmp_path / "checkpoint"), ordered.apply_ordered(layer, ["at", "version"], "gone"))
        assert spark.conf.get(STATE_STORE_CONF) == default
    finally:
        spark.conf.set(STATE_STORE_CONF, before)
    assert [(r.id, r.value) for r in layer.read().collect()] == [("a", "a2")]


def test_the_query_in_a_session_with_the_default_state_store(spark):
    import check_queries

    from __spark_entry__ import oracle_sql, queries

    before = spark.conf.get(STATE_STORE_CONF)
    try:
        spark.conf.unset(STATE_STORE_CONF)
        found = queries()["stream_ordered_apply"](spark, SMALL)
        con = check_queries.connect(SMALL)
        assert check_queries.compare(found, con, oracle_sql()["stream_ordered_apply"]) == ""
    finally:
        spark.conf.set(STATE_STORE_CONF, before)
