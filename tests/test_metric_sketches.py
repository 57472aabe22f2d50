"""Distinct counts from sketches: the error bound, merged periods, requests that have none."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tarnlake.operators import scope
from tarnlake.plans import metrics
from tarnlake.plans.model import Dimension, Entity, Metric, MetricModel, MetricQueryError, MetricRequest, TimeDimension

EVERYONE = scope.unrestricted("definition_validation")


@pytest.fixture(scope="module")
def model():
    visits = Entity(
        "visit",
        (Dimension("site", "site"),),
        (Metric("people", "count_distinct", "who"), Metric("rows", "count", "*")),
        times=(TimeDimension("day", "day", "month"),),
    )
    return MetricModel((visits,))


@pytest.fixture(scope="module")
def visits(spark):
    n = F.col("id")
    return spark.range(60_000).select(
        F.when(n % 5 == 0, "small").otherwise("large").alias("site"),
        F.when(n % 11 != 0, (n * 7919) % 23_000).alias("who"),
        F.date_add(F.lit(date(2024, 1, 1)), (n % 180).cast("int")).alias("day"),
    )


def test_estimates_are_within_the_stated_error(model, visits):
    got = {}
    for rough in (True, False):
        request = MetricRequest("visit", ("people", "rows"), ("site",), approximate_distinct=rough)
        rows = metrics.metric_query(model, request, {"visit": visits}, scope=EVERYONE).collect()
        got[rough] = {r.site: (r.people, r.rows) for r in rows}
    for site, (people, rows) in got[False].items():
        assert abs(got[True][site][0] - people) <= metrics.SKETCH_ERROR * people and got[True][site][1] == rows


def test_periods_merge_without_counting_twice(spark, model, visits, tmp_path):
    request = MetricRequest("visit", ("people",), ("site",), time="day", grain="month")
    path = str(tmp_path / "sketches")
    metrics.distinct_sketches(model, request, {"visit": visits}, scope=EVERYONE).write.parquet(path)
    quarter = metrics.merge_sketches(spark.read.parquet(path), "day", date(2024, 1, 1), date(2024, 4, 1), ["site"], ["people"])
    inside = visits.where("day < DATE '2024-04-01'").groupBy("site").agg(F.count_distinct("who").alias("n"))
    exact = {r.site: r.n for r in inside.collect()}
    assert {r.site for r in quarter.collect()} == set(exact)
    for r in quarter.collect():
        assert abs(r.people - exact[r.site]) <= metrics.SKETCH_ERROR * exact[r.site]


def test_requests_without_sketches(model, visits):
    for request in (MetricRequest("visit", ("rows",), time="day"), MetricRequest("visit", ("people",))):
        with pytest.raises(MetricQueryError):
            metrics.distinct_sketches(model, request, {"visit": visits}, scope=EVERYONE)
