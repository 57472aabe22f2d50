"""Peer benchmarks that cannot reveal a single unit, and metric alerts."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.operators.scope import SCOPE_COLUMN

# Benchmark functions, combinations that reveal a unit's figure, smallest peer group.
FUNCTIONS = frozenset({"count", "sum", "average", "median", "min", "max", "rank", "percentile"})
REVEALING = (
    frozenset({"rank", "average"}),
    frozenset({"rank", "sum"}),
    frozenset({"min", "max", "average"}),
)
MIN_PEERS = 5


class RevealingBenchmark(PermissionError):
    """The requested functions together give away one unit's figure."""


def check_functions(functions: Iterable[str], minimum: int = MIN_PEERS) -> frozenset[str]:
    wanted = frozenset(functions)
    if minimum < 2:
        raise ValueError("the smallest peer group is at least 2")
    if wanted - FUNCTIONS:
        raise ValueError(f"unknown benchmark functions {sorted(wanted - FUNCTIONS)}")
    if any(combination <= wanted for combination in REVEALING):
        raise RevealingBenchmark(f"{sorted(wanted)} permits back-computation of one unit's figure")
    return wanted


def peer_counts(per_unit: DataFrame, cohort: list[str], viewer_units: Iterable[str]) -> DataFrame:
    """Units and peers (units the viewer cannot see anyway) of every cohort."""
    seen = sorted(set(viewer_units))
    is_peer = ~F.col(SCOPE_COLUMN).isin(*seen) if seen else F.lit(True)
    return per_unit.groupBy(*cohort).agg(
        F.count_distinct(SCOPE_COLUMN).alias("cohort_size"),
        F.count_distinct(F.when(is_peer, F.col(SCOPE_COLUMN))).alias("peers"),
    )


def peer_benchmark(
    per_unit: DataFrame,
    value: str,
    cohort: list[str],
    functions: Iterable[str],
    viewer_units: Iterable[str],
    minimum: int = MIN_PEERS,
    scale: int | None = None,
) -> DataFrame:
    """Benchmark of a figure over cohorts of units; cohorts with too few peers are left out.

    ``per_unit`` is already aggregated to one row per unit and cohort, so its size is the number of
    units. ``rank`` and ``percentile`` give a row per unit, the other functions a row per cohort.
    """
    wanted = check_functions(functions, minimum)
    sizes = peer_counts(per_unit, cohort, viewer_units)
    allowed = sizes.where(F.col("peers") >= minimum).drop("peers")
    rows = per_unit.join(allowed, cohort)
    per_row = wanted & {"rank", "percentile"}
    if per_row:
        w = Window.partitionBy(*cohort)
        extra: dict[str, Column] = {}
        if "rank" in wanted:
            extra["rank"] = F.rank().over(w.orderBy(F.col(value).desc()))
        if "percentile" in wanted:
            extra["percentile"] = F.percent_rank().over(w.orderBy(F.col(value))) * 100.0
        return rows.withColumns(extra).drop("cohort_size")
    col = F.col(value)
    exact = F.sum(col.cast(f"decimal(18,{scale})")).cast("double") if scale is not None else F.sum(col)
    aggregates = {
        "count": F.count(col),
        "sum": exact,
        "average": F.try_divide(exact, F.count(col)),
        "median": F.median(col),
        "min": F.min(col),
        "max": F.max(col),
    }
    return rows.groupBy(*cohort).agg(
        F.max("cohort_size").alias("cohort_size"),
        *[aggregates[f].alias(f) for f in sorted(wanted)],
    )


@dataclass(frozen=True)
class AlertCondition:
    metric: str
    operator: str
    threshold: float


ALERT_OPERATORS = ("gt", "gte", "lt", "lte", "eq", "ne", "changed_by_pct_above")
MAX_CONDITIONS = 10


def _passes(condition: AlertCondition, previous: str | None) -> Column:
    observed, limit = F.col(condition.metric).cast("double"), F.lit(float(condition.threshold))
    if condition.operator == "changed_by_pct_above":
        if previous is None:
            raise ValueError("a change condition needs a previous value")
        before = F.col(previous).cast("double")
        change = F.try_divide(F.abs(observed - before), F.abs(before)) * 100.0
        return F.coalesce(change > limit, F.lit(False))
    compare = {
        "gt": observed > limit,
        "gte": observed >= limit,
        "lt": observed < limit,
        "lte": observed <= limit,
        "eq": observed == limit,
        "ne": observed != limit,
    }[condition.operator]
    return F.coalesce(compare, F.lit(False))


def evaluate_alerts(
    results: DataFrame, conditions: list[AlertCondition], previous: dict[str, str] | None = None
) -> DataFrame:
    """Add ``condition_<n>`` and ``fires``; a missing value never passes, all must pass to fire."""
    if not 1 <= len(conditions) <= MAX_CONDITIONS:
        raise ValueError(f"an alert has 1..{MAX_CONDITIONS} conditions")
    flags = {
        f"condition_{i + 1}": _passes(c, (previous or {}).get(c.metric))
        for i, c in enumerate(conditions)
    }
    return results.withColumns(flags).withColumn(
        "fires", reduce(lambda a, b: a & b, [F.col(f) for f in flags])
    )


def with_previous(
    results: DataFrame, metric: str, period: str, groups: list[str]
) -> DataFrame:
    """Add ``<metric>_previous``: the value of the period before, within each group.

    Groups are required: without any, one task would sort all results.
    """
    if not groups:
        raise ValueError("the value before needs the columns of its series")
    w = Window.partitionBy(*groups).orderBy(period)
    return results.withColumn(f"{metric}_previous", F.lag(metric).over(w))
