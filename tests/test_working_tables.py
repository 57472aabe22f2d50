"""Working tables of a run go with it; what was written stays."""

from __future__ import annotations

import os

import pytest

from tarnlake import session


def _folders(spark, label):
    base = session.shared_base(spark).removeprefix("file://")
    return [n for n in os.listdir(base) if n.startswith(label)]


def test_tables_of_a_run_are_removed(spark, tmp_path):
    kept = session.cut_lineage(spark.range(3), "outside")
    with session.working_tables(spark):
        inner = session.cut_lineage(spark.range(5), "inside")
        with session.working_tables(spark):
            assert session.cut_lineage(inner, "inside").count() == 5
            assert len(_folders(spark, "inside")) == 2
        assert len(_folders(spark, "inside")) == 1
        inner.write.parquet(str(tmp_path / "result"))
    assert not _folders(spark, "inside") and kept.count() == 3
    assert spark.read.parquet(str(tmp_path / "result")).count() == 5


def test_tables_go_after_an_error_too(spark):
    with pytest.raises(RuntimeError), session.working_tables(spark):
        session.cut_lineage(spark.range(1), "broken")
        raise RuntimeError
    assert not _folders(spark, "broken")
