"""The transformation job reads the raw rows once and merges into touched buckets only."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tarnlake.operators import mapping, quality, scope
from tarnlake.plans import jobs
from tarnlake.sources.keyed_layer import KeyedLayer

SCHEMA = "id string, owner string, status string, parent string, day string, rev int, gone boolean"
RULES = (
    mapping.MappingRule(("id",), "order_id", "rename", {}, "raise_error"),
    mapping.MappingRule(("owner",), "owner", "rename", {}),
    mapping.MappingRule(("status",), "status", "rename", {}),
    mapping.MappingRule(("parent",), "parent", "rename", {}),
    mapping.MappingRule(("day",), "day", "rename", {}),
    mapping.MappingRule(("rev",), "rev", "cast", {"type": "integer"}),
    mapping.MappingRule(("gone",), "gone", "cast", {"type": "boolean"}),
)


def _raw(spark, bad="X"):
    rows = [(f"o{i}", "u1", "O", f"p{i % 3}", "2024-01-01", i, False) for i in range(60)]
    rows += [("o1", "u1", bad, "p9", "1900-01-01", 100, False), (None, "u1", "O", "p1", None, 1, False)]
    rows += [("o2", "u1", "O", "p0", "2024-01-01", 100, True), ("", "zz", "O", "p0", "2024-01-01", 1, False)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def _spec(spark, mode="warn", severity="warning"):
    parents = spark.createDataFrame([("p0",), ("p1",), ("p2",), ("p2",)], "k string")
    policy = quality.BatchPolicy(
        required=("status", "day"), natural_key=("order_id",), date_fields=("day",),
        foreign_keys=(quality.ForeignKey("parent", parents, "k"),), mode=mode,
    )
    return jobs.TransformSpec(
        RULES, ("order_id",), ("rev",), scope.Attribution(field="owner"),
        (quality.AllowedCheck("status", frozenset({"O"}), severity),), policy, soft_delete="gone",
    )


def _units(spark):
    return spark.createDataFrame([("u1",)], "scope_unit_id string")


def test_the_raw_rows_are_read_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            read.add(len(frame))
            yield frame

    raw = _raw(spark).mapInPandas(count, SCHEMA)
    layer = KeyedLayer(spark, str(tmp_path / "layer"), ["order_id"], 1 << 10)
    done, merged = jobs.transform_into(layer, raw, _spec(spark), _units(spark))
    assert done.curated.count() == 59 and done.rejected.count() == 2
    assert done.violations.count() == 1 and done.outcomes.count() == 4
    assert merged.delta_rows == 62 and read.value == 64


def test_measures_equal_those_of_the_separate_checks(spark):
    spec = _spec(spark)
    done = jobs.transform(_raw(spark), spec, None, _units(spark))
    mapped, rejected = mapping.map_fields(_raw(spark), RULES, False)
    want = quality.batch_checks(mapped, spec.batch_policy)
    assert sorted(map(tuple, done.outcomes.collect())) == sorted(map(tuple, want.collect()))
    assert sorted(map(tuple, done.rejected.collect()), key=repr) == sorted(map(tuple, rejected.collect()), key=repr)
    checked = quality.record_violations(mapped, spec.checks, ["order_id"])
    assert sorted(map(tuple, done.violations.collect())) == sorted(map(tuple, checked.collect()))


def test_a_second_delta_touches_few_buckets_and_a_blocked_one_none(spark, tmp_path):
    layer = KeyedLayer(spark, str(tmp_path / "layer"), ["order_id"], 512)
    jobs.transform_into(layer, _raw(spark), _spec(spark), _units(spark))
    buckets = layer.manifest().count()
    small = _raw(spark).where("id = 'o7'").withColumn("rev", F.lit(500))
    _, merged = jobs.transform_into(layer, small, _spec(spark), _units(spark))
    assert buckets > 4 and merged.buckets == 1 and layer.version() == 2
    assert {r.rev for r in layer.read().where("order_id = 'o7'").collect()} == {500}
    for spec in (_spec(spark, "block"), _spec(spark, severity="blocking")):
        done, merged = jobs.transform_into(layer, _raw(spark), spec, _units(spark))
        assert done.blocked and done.curated is None and merged is None and layer.version() == 2


def test_rejected_rows_do_not_reach_strict_casts(spark):
    rules = (mapping.MappingRule(("id",), "id", "rename", {}, "raise_error"),
             mapping.MappingRule(("n",), "n", "cast", {"type": "integer"}))
    raw = spark.createDataFrame([(None, "bad"), ("a", "5")], "id string, n string")
    spec = jobs.TransformSpec(rules, ("id",), ("n",), scope.Attribution(single=True), strict=True)
    done = jobs.transform(raw, spec)
    assert [r.n for r in done.curated.collect()] == [5] and [r.n for r in done.rejected.collect()] == ["bad"]
    wrong = spark.createDataFrame([("a", "bad")], "id string, n string")
    with pytest.raises(Exception, match="CAST|cast"):
        jobs.transform(wrong, spec)


def test_empty_delta(spark, tmp_path):
    layer = KeyedLayer(spark, str(tmp_path / "layer"), ["order_id"])
    done, merged = jobs.transform_into(layer, _raw(spark).limit(0), _spec(spark), _units(spark))
    assert not done.blocked and done.curated.count() == 0 and merged.delta_rows == 0
