"""Governed metric queries: a checked request becomes one DataFrame plan."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.fiscal import inclusive
from tarnlake.operators.scope import SCOPE_COLUMN, ScopeFilter
from tarnlake.plans.model import (
    AccessDenied,
    Entity,
    FieldFilter,
    Metric,
    MetricModel,
    MetricQueryError,
    MetricRequest,
)

MIN_CELL = 5


def _require(tag: str | None, granted: frozenset[str], name: str) -> None:
    if tag is not None and tag not in granted:
        raise AccessDenied(f"{name!r} needs the access tag {tag!r}")


#: Size of distinct-count sketches (a power of two), and the relative error that an estimate stays
#: within in practice: three standard errors.
SKETCH_BITS = 12
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def _sketch(metric: Metric, prefix: str) -> Column:
    return F.hll_sketch_agg(F.col(prefix + metric.column).cast("string"), SKETCH_BITS)


def _aggregate(metric: Metric, prefix: str = "", approximate: bool = False) -> Column:
    if metric.column == "*":
        return F.count(F.lit(1))
    col = F.col(prefix + metric.column)
    if metric.aggregation == "count":
        return F.count(col)
    if metric.aggregation == "count_distinct":
        return F.hll_sketch_estimate(_sketch(metric, prefix)) if approximate else F.count_distinct(col)
    if metric.aggregation == "min":
        return F.min(col)
    if metric.aggregation == "max":
        return F.max(col)
    if metric.scale is None:
        return F.sum(col) if metric.aggregation == "sum" else F.avg(col)
    total = F.sum(col.cast(f"decimal(18,{metric.scale})")).cast("double")
    return total if metric.aggregation == "sum" else F.try_divide(total, F.count(col))


def _condition(column: Column, f: FieldFilter) -> Column:
    if f.operator == "is_null":
        return column.isNull()
    if f.operator == "not_null":
        return column.isNotNull()
    if f.operator == "in":
        return column.isin(*f.values)
    if f.operator == "not_in":
        return ~column.isin(*f.values)
    value = F.lit(f.value)
    return {
        "eq": column == value,
        "ne": column != value,
        "gt": column > value,
        "gte": column >= value,
        "lt": column < value,
        "lte": column <= value,
    }[f.operator]


def time_bounds(
    model: MetricModel, request: MetricRequest, grain: str, today: date
) -> tuple[date, date] | None:
    """Half-open day bounds a request asks for."""
    if request.time_range is not None:
        if request.time_range.relative is not None:
            return model.calendar.relative(request.time_range.relative, today)
        return inclusive(request.time_range.start, request.time_range.end)
    if request.comparison != "none":
        return model.calendar.comparison(today, grain, request.comparison)
    return None


def _check_access(entity: Entity, model: MetricModel, request: MetricRequest, tags: frozenset[str]):
    for name in request.dimensions:
        _require(entity.dimension(name).tag, tags, name)
    for target, name in request.joined:
        entity.join_to(target)
        _require(model.entity(target).dimension(name).tag, tags, f"{target}.{name}")
    for f in request.filters:
        _require(entity.dimension(f.dimension).tag, tags, f.dimension)
    if request.time is not None:
        _require(entity.time(request.time).tag, tags, request.time)
    for name in request.metrics:
        metric = entity.metric(name)
        for part in (name, metric.numerator, metric.denominator):
            if part is not None:
                _require(entity.metric(part).tag, tags, part)


def _parts(entity: Entity, names: tuple[str, ...]) -> list[Metric]:
    """The aggregates that have to be computed for the requested metrics, each once."""
    needed: dict[str, Metric] = {}
    for name in names:
        metric = entity.metric(name)
        for part in (metric.numerator, metric.denominator) if metric.derived else (name,):
            needed[part] = entity.metric(part)
    return list(needed.values())


def _finish(entity: Entity, name: str) -> Column:
    metric = entity.metric(name)
    if not metric.derived:
        return F.col(f"_m_{name}").alias(name)
    top, bottom = F.col(f"_m_{metric.numerator}"), F.col(f"_m_{metric.denominator}")
    if metric.kind == "difference":
        return (top - bottom).alias(name)
    ratio = F.try_divide(top.cast("double"), bottom.cast("double"))
    return (F.coalesce(ratio, F.lit(0.0)) if metric.zero_when_undefined else ratio).alias(name)


def _grouped(
    model: MetricModel,
    request: MetricRequest,
    sources: Mapping[str, DataFrame],
    tags: frozenset[str],
    scope: ScopeFilter,
    extra_group: tuple[str, Column] | None = None,
    bounds: tuple[date, date] | None = None,
    group_by_time: bool = True,
    make: Callable[[Metric, str], Column] | None = None,
) -> tuple[Entity, list[str], DataFrame]:
    """Scope filter, joins, filters and the one aggregation; metrics are still named ``_m_*``."""
    entity = model.entity(request.entity)
    _check_access(entity, model, request, tags)
    parts = _parts(entity, request.metrics)
    base = sources[request.entity]
    if scope.units is not None:
        if SCOPE_COLUMN not in base.columns:
            raise MetricQueryError(f"entity {entity.name!r} has no {SCOPE_COLUMN} column")
        base = scope.apply(base)
    for f in request.filters:
        base = base.where(_condition(F.col(entity.dimension(f.dimension).column), f))
    groups: list[Column] = []
    names: list[str] = []
    for name in request.dimensions:
        groups.append(F.col(f"b_{entity.dimension(name).column}").alias(name))
        names.append(name)
    used = [entity.dimension(n).column for n in request.dimensions]
    used += [m.column for m in parts if m.column != "*"]
    if request.time is not None:
        time = entity.time(request.time)
        used.append(time.column)
        if bounds is not None:
            day = F.col(time.column)
            base = base.where((day >= F.lit(bounds[0])) & (day < F.lit(bounds[1])))
        if group_by_time:
            grain = request.grain or time.grain
            groups.append(
                model.calendar.truncated(F.col(f"b_{time.column}"), grain).alias(request.time)
            )
            names.append(request.time)
    targets = list(dict.fromkeys(t for t, _ in request.joined))
    used += [entity.join_to(t).local_column for t in targets]
    if extra_group is not None:
        base = base.withColumn(extra_group[0], extra_group[1])
        used.append(extra_group[0])
        groups.append(F.col(f"b_{extra_group[0]}").alias(extra_group[0]))
    plan = base.select(*[F.col(c).alias(f"b_{c}") for c in dict.fromkeys(used)])
    for index, target_name in enumerate(targets):
        join = entity.join_to(target_name)
        target = model.entity(target_name)
        wanted = [target.dimension(n).column for t, n in request.joined if t == target_name]
        side = sources[target_name]
        if SCOPE_COLUMN in side.columns:
            side = scope.apply(side)
        side = side.select(
            *[F.col(c).alias(f"j{index}_{c}") for c in dict.fromkeys([join.target_column, *wanted])]
        )
        plan = plan.join(
            side, F.col(f"b_{join.local_column}") == F.col(f"j{index}_{join.target_column}"), join.kind
        )
        for t, n in request.joined:
            if t == target_name:
                label = f"{target_name}_{n}"
                groups.append(F.col(f"j{index}_{target.dimension(n).column}").alias(label))
                names.append(label)
    if make is None:
        make = lambda m, prefix: _aggregate(m, prefix, request.approximate_distinct)
    aggregates = [make(m, "b_").alias(f"_m_{m.name}") for m in parts]
    return entity, names, plan.groupBy(*groups).agg(*aggregates)


def metric_query(
    model: MetricModel,
    request: MetricRequest,
    sources: Mapping[str, DataFrame],
    *,
    tags: frozenset[str] = frozenset(),
    scope: ScopeFilter,
    today: date | None = None,
) -> DataFrame:
    """Rows of a governed request.

    The scope filter goes first and also covers joined entities that carry the scope column. Time
    groups start on the model's fiscal calendar. Without a row limit in the request every group is
    returned; with one, the first groups by their names, and ``rows_cut`` tells what is missing.
    """
    bounds = None
    if request.time is not None:
        grain = request.grain or model.entity(request.entity).time(request.time).grain
        bounds = time_bounds(model, request, grain, today or date.today())
    entity, names, grouped = _grouped(model, request, sources, tags, scope, bounds=bounds)
    result = grouped.select(*names, *[_finish(entity, m) for m in request.metrics])
    return _limited(result, names, request.row_limit)


def distinct_sketches(
    model: MetricModel,
    request: MetricRequest,
    sources: Mapping[str, DataFrame],
    *,
    tags: frozenset[str] = frozenset(),
    scope: ScopeFilter,
) -> DataFrame:
    """The groups of a request, its period included, with a mergeable sketch per metric.

    Stored by period, they answer later requests over several periods without the rows
    (``merge_sketches``). Every metric must be a distinct count.
    """
    for name in request.metrics:
        metric = model.entity(request.entity).metric(name)
        if metric.derived or metric.aggregation != "count_distinct":
            raise MetricQueryError(f"{name!r} is no distinct count")
    if request.time is None:
        raise MetricQueryError("sketches are kept by period: name a time dimension")
    _, names, grouped = _grouped(model, request, sources, tags, scope, make=_sketch)
    return grouped.select(*names, *[F.col(f"_m_{m}").alias(m) for m in request.metrics])


def merge_sketches(
    stored: DataFrame, period: str, start: date, end: date, groups: list[str], metrics: list[str]
) -> DataFrame:
    """Distinct counts over the stored periods that begin in ``[start, end)``, by group.

    Values that several periods share count once; the error bound is that of one sketch.
    """
    day = F.col(period)
    return (
        stored.where((day >= F.lit(start)) & (day < F.lit(end)))
        .groupBy(*groups)
        .agg(*[F.hll_sketch_estimate(F.hll_union_agg(m)).alias(m) for m in metrics])
    )


def _limited(result: DataFrame, names: list[str], limit: int | None) -> DataFrame:
    """The first groups in the order of their names; all of them without a limit."""
    return result if limit is None else result.orderBy(*names).limit(limit)


def rows_cut(result: DataFrame, request: MetricRequest) -> DataFrame:
    """One row ``rows, rows_cut`` for the unlimited result of a request: groups in all and how many
    its row limit leaves out."""
    left_out = F.lit(0).cast("long")
    if request.row_limit is not None:
        left_out = F.greatest(F.count(F.lit(1)) - request.row_limit, left_out)
    return result.agg(F.count(F.lit(1)).alias("rows"), left_out.alias("rows_cut"))


def compare_periods(
    model: MetricModel,
    request: MetricRequest,
    sources: Mapping[str, DataFrame],
    *,
    scope: ScopeFilter,
    today: date,
    against: str = "prior_period",
    tags: frozenset[str] = frozenset(),
) -> DataFrame:
    """Each metric for the period of ``today`` and for a comparison period, side by side.

    Both periods come from one scan and one aggregation. Adds ``<metric>_previous`` and
    ``<metric>_change_pct``.
    """
    entity = model.entity(request.entity)
    time = entity.time(request.time)
    grain = request.grain or time.grain
    current = model.calendar.comparison(
        today, grain, "period_to_date" if against == "period_to_date" else "none"
    )
    if against == "period_to_date":
        # like for like: as many days of the prior period as have passed of this one
        start = model.calendar.comparison(today, grain, "prior_period")[0]
        previous = (start, min(start + (current[1] - current[0]), current[0]))
    else:
        previous = model.calendar.comparison(today, grain, against)
    day = F.col(time.column)

    def within(span: tuple[date, date]) -> Column:
        return (day >= F.lit(span[0])) & (day < F.lit(span[1]))

    label = F.when(within(current), "current").when(within(previous), "previous")
    scoped = {**sources, request.entity: sources[request.entity].where(within(current) | within(previous))}
    entity, names, grouped = _grouped(
        model, request, scoped, tags, scope, extra_group=("_period", label), group_by_time=False
    )
    finished = grouped.select(*names, "_period", *[_finish(entity, m) for m in request.metrics])
    picks = []
    for metric in request.metrics:
        for period, suffix in (("current", ""), ("previous", "_previous")):
            picks.append(
                F.max(F.when(F.col("_period") == period, F.col(metric))).alias(metric + suffix)
            )
    wide = finished.groupBy(*names).agg(*picks)
    changes = {
        f"{m}_change_pct": F.try_divide(
            (F.col(m) - F.col(f"{m}_previous")).cast("double") * 100.0,
            F.abs(F.col(f"{m}_previous").cast("double")),
        )
        for m in request.metrics
    }
    return _limited(wide.withColumns(changes), names, request.row_limit)


def suppress_small_cells(df: DataFrame, counts: list[str], floor: int = MIN_CELL) -> DataFrame:
    """Null out counts below the floor; the rows stay."""
    return df.withColumns({c: F.when(F.col(c) >= floor, F.col(c)) for c in counts})


def count_metrics(entity: Entity, names: tuple[str, ...]) -> list[str]:
    return [n for n in names if entity.metric(n).aggregation.startswith("count") and not entity.metric(n).derived]


def governed_columns(entity: Entity, tags: frozenset[str], with_scope: bool = True) -> list[str]:
    """Columns of a governed view: those whose tag is granted, each once, in declared order."""
    columns = [d.column for d in entity.dimensions if d.tag is None or d.tag in tags]
    columns += [t.column for t in entity.times if t.tag is None or t.tag in tags]
    columns += [
        m.column
        for m in entity.metrics
        if not m.derived and m.column != "*" and (m.tag is None or m.tag in tags)
    ]
    if with_scope:
        columns.append(SCOPE_COLUMN)
    if not columns:
        raise MetricQueryError(f"no column of {entity.name!r} is visible")
    return list(dict.fromkeys(columns))


def governed_view(entity: Entity, df: DataFrame, tags: frozenset[str]) -> DataFrame:
    """Register and return ``vw_<entity>``; columns without a granted tag are left out."""
    view = df.select(*governed_columns(entity, tags))
    view.createOrReplaceTempView(f"vw_{entity.name.replace('-', '_')}")
    return view


def governed_views(
    model: MetricModel, sources: Mapping[str, DataFrame], tags: frozenset[str]
) -> dict[str, DataFrame]:
    """A governed view for every entity that has data; an entity with nothing visible is skipped."""
    views = {}
    for entity in model.entities:
        if entity.name in sources:
            try:
                views[entity.name] = governed_view(entity, sources[entity.name], tags)
            except MetricQueryError:
                continue
    return views


def restatement(before: DataFrame, after: DataFrame, keys: list[str], metric: str) -> DataFrame:
    """Periods whose figure differs between two results of a metric, with both figures."""
    old = before.select(*keys, F.col(metric).alias("value_before"))
    new = after.select(*keys, F.col(metric).alias("value_after"))
    joined = old.join(new, keys, "full_outer")
    return joined.where(~F.col("value_before").eqNullSafe(F.col("value_after"))).withColumn(
        "metric", F.lit(metric)
    )
