"""Metric model, scope and calendar queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.fiscal import FiscalCalendar
from tarnlake.operators import scope
from tarnlake.operators.benchmark import peer_benchmark
from tarnlake.plans import metrics
from tarnlake.plans.model import (
    Dimension,
    Entity,
    EntityJoin,
    FieldFilter,
    Metric,
    MetricModel,
    MetricRequest,
    TimeDimension,
    TimeRange,
)
from tarnlake.registry.base import Tables, query
from tarnlake.session import work_path

TODAY = date(1999, 8, 15)



def sales_model(start_month: int = 1) -> MetricModel:
    sales = Entity(
        "sales_order",
        (
            Dimension("order_status", "order_status"),
            Dimension("service_line", "service_line"),
            Dimension("scope_unit_id", "scope_unit_id"),
            Dimension("refund", "refund_amount"),
        ),
        (
            Metric("sales", "sum", "gross_booked_amount", scale=2, tag="finance"),
            Metric("refunds", "sum", "refund_amount", scale=2, tag="finance"),
            Metric("order_count", "count_distinct", "order_id"),
            Metric("rows", "count"),
            Metric("smallest", "min", "gross_booked_amount"),
            Metric("largest", "max", "gross_booked_amount"),
            Metric("mean", "avg", "gross_booked_amount", scale=2),
            Metric("customers", "count_distinct", "customer_id"),
            Metric("average_order_value", kind="ratio", numerator="sales", denominator="order_count", tag="finance"),
            Metric("refund_ratio", kind="ratio", numerator="sales", denominator="refunds", zero_when_undefined=True, tag="finance"),
            Metric("net_sales", kind="difference", numerator="sales", denominator="refunds", tag="finance"),
        ),
        (TimeDimension("activity_date", "activity_date"),),
        (EntityJoin("company", "customer_id", "c_custkey"),),
    )
    company = Entity(
        "company",
        (Dimension("industry", "industry"), Dimension("brand_code", "brand_code"), Dimension("name", "c_name", tag="pii")),
        (Metric("company_count", "count"),),
    )
    return MetricModel((sales, company), calendar=FiscalCalendar(start_month))


FINANCE = frozenset({"finance"})
EVEN_UNITS = tuple(f"unit-{n}" for n in range(0, 25, 2))


def even_units() -> scope.ScopeFilter:
    return scope.scope_filter(scope.ScopeClaims(frozenset(EVEN_UNITS)))


def _sources(t: Tables) -> dict[str, DataFrame]:
    return {"sales_order": t.sales, "company": t.accounts}


_IN_EVEN = "(" + ", ".join(f"'{u}'" for u in EVEN_UNITS) + ")"
_SUM = "cast(sum(cast({} AS decimal(18,2))) AS double)"


@query(
    "semantic_sales_by_segment",
    f"""
    SELECT cast(date_trunc('month', s.activity_date) AS date) AS activity_date,
           c.industry AS company_industry,
           {_SUM.format('gross_booked_amount')} AS sales,
           count(DISTINCT order_id) AS order_count,
           {_SUM.format('gross_booked_amount')} / count(DISTINCT order_id) AS average_order_value
    FROM {{sales}} s LEFT JOIN
         (SELECT * FROM {{accounts}} x WHERE scope_unit_id IN {_IN_EVEN}) c
         ON s.customer_id = c.c_custkey
    WHERE s.scope_unit_id IN {_IN_EVEN} GROUP BY ALL
    """,
)
def semantic_sales_by_segment(t: Tables) -> DataFrame:
    request = MetricRequest(
        "sales_order",
        ("sales", "order_count", "average_order_value"),
        joined=(("company", "industry"),),
        time="activity_date",
        grain="month",
    )
    return metrics.metric_query(
        sales_model(), request, _sources(t), tags=FINANCE, scope=even_units(), today=TODAY
    )


@query(
    "semantic_ratio",
    f"""
    SELECT order_status,
           coalesce({_SUM.format('gross_booked_amount')}
             / nullif({_SUM.format('refund_amount')}, 0), 0) AS refund_ratio,
           {_SUM.format('gross_booked_amount')} / count(DISTINCT order_id) AS average_order_value
    FROM {{sales}} GROUP BY order_status
    """,
)
def semantic_ratio(t: Tables) -> DataFrame:
    request = MetricRequest("sales_order", ("refund_ratio", "average_order_value"), ("order_status",))
    everything = scope.scope_filter(scope.ScopeClaims(tenant_wide=True))
    return metrics.metric_query(sales_model(), request, _sources(t), tags=FINANCE, scope=everything)


@query(
    "semantic_difference",
    f"""
    SELECT service_line, {_SUM.format('gross_booked_amount')} - {_SUM.format('refund_amount')} AS net_sales
    FROM {{sales}} GROUP BY service_line
    """,
)
def semantic_difference(t: Tables) -> DataFrame:
    request = MetricRequest("sales_order", ("net_sales",), ("service_line",))
    return metrics.metric_query(
        sales_model(), request, _sources(t), tags=FINANCE, scope=scope.unrestricted("definition_validation")
    )


@query(
    "semantic_aggregations",
    f"""
    SELECT order_status, count(*) AS rows, count(DISTINCT customer_id) AS customers,
           min(gross_booked_amount) AS smallest, max(gross_booked_amount) AS largest,
           {_SUM.format('gross_booked_amount')} / count(gross_booked_amount) AS mean
    FROM {{sales}} GROUP BY order_status
    """,
)
def semantic_aggregations(t: Tables) -> DataFrame:
    request = MetricRequest(
        "sales_order", ("rows", "customers", "smallest", "largest", "mean"), ("order_status",)
    )
    return metrics.metric_query(
        sales_model(), request, _sources(t), scope=scope.unrestricted("definition_validation")
    )


_DISTINCT = ("customers", "order_count")


def _near_exact(estimated: DataFrame, exact: DataFrame, keys: list[str]) -> DataFrame:
    """Exact counts, and whether the estimates lie within the stated error of them."""
    guess = estimated.select(*keys, *[F.col(m).alias(f"_{m}") for m in _DISTINCT])
    error = lambda m: F.abs(F.col(f"_{m}") - F.col(m)) <= metrics.SKETCH_ERROR * F.col(m)
    return exact.join(guess, keys).select(*keys, *_DISTINCT, (error(_DISTINCT[0]) & error(_DISTINCT[1])).alias("near"))


@query(
    "semantic_distinct_sketch",
    """
    SELECT order_status, count(DISTINCT customer_id) AS customers, count(DISTINCT order_id) AS order_count, true AS near
    FROM {sales} GROUP BY order_status
    """,
)
def semantic_distinct_sketch(t: Tables) -> DataFrame:
    """Distinct counts from sketches next to the exact ones."""
    both = [
        metrics.metric_query(
            sales_model(),
            MetricRequest("sales_order", _DISTINCT, ("order_status",), approximate_distinct=rough),
            _sources(t),
            scope=scope.unrestricted("definition_validation"),
        )
        for rough in (True, False)
    ]
    return _near_exact(*both, ["order_status"])


@query(
    "semantic_quarter_of_sketches",
    """
    SELECT order_status, count(DISTINCT customer_id) AS customers, count(DISTINCT order_id) AS order_count, true AS near
    FROM {sales} WHERE activity_date >= DATE '1996-04-01' AND activity_date < DATE '1996-07-01' GROUP BY order_status
    """,
)
def semantic_quarter_of_sketches(t: Tables) -> DataFrame:
    """A quarter from stored months: only the sketches are read again."""
    everyone = scope.unrestricted("definition_validation")
    monthly = MetricRequest("sales_order", _DISTINCT, ("order_status",), time="activity_date", grain="month")
    path = work_path(t.spark, "sketches")
    metrics.distinct_sketches(sales_model(), monthly, _sources(t), scope=everyone).write.parquet(path)
    quarter = (date(1996, 4, 1), date(1996, 7, 1))
    merged = metrics.merge_sketches(
        t.spark.read.parquet(path), "activity_date", *quarter, ["order_status"], list(_DISTINCT)
    )
    request = MetricRequest(
        "sales_order", _DISTINCT, ("order_status",), time="activity_date", grain="quarter",
        time_range=TimeRange(start=quarter[0], end=date(1996, 6, 30)),
    )
    exact = metrics.metric_query(sales_model(), request, _sources(t), scope=everyone)
    return _near_exact(merged, exact, ["order_status"])


@query(
    "semantic_filters",
    """
    SELECT service_line, count(DISTINCT order_id) AS order_count FROM {sales}
    WHERE order_status IN ('O', 'P') AND service_line <> '5-LOW' AND service_line >= '2'
      AND service_line NOT IN ('4-NOT SPECIFIED') AND refund_amount IS NOT NULL
      AND activity_date >= DATE '1997-01-01' AND activity_date < DATE '1999-01-01'
    GROUP BY service_line
    """,
)
def semantic_filters(t: Tables) -> DataFrame:
    request = MetricRequest(
        "sales_order",
        ("order_count",),
        ("service_line",),
        filters=(
            FieldFilter("order_status", "in", values=("O", "P")),
            FieldFilter("service_line", "ne", "5-LOW"),
            FieldFilter("service_line", "gte", "2"),
            FieldFilter("service_line", "not_in", values=("4-NOT SPECIFIED",)),
            FieldFilter("refund", "not_null"),
        ),
        time="activity_date",
        grain="year",
        time_range=TimeRange(start=date(1997, 1, 1), end=date(1998, 12, 31)),
    )
    by_year = metrics.metric_query(
        sales_model(), request, _sources(t), scope=scope.unrestricted("definition_validation")
    )
    return by_year.groupBy("service_line").agg(F.sum("order_count").alias("order_count"))


@query(
    "semantic_relative_range",
    f"""
    SELECT order_status, cast(date_trunc('month', activity_date) AS date) AS activity_date,
           count(DISTINCT order_id) AS order_count
    FROM {{sales}}
    WHERE activity_date >= DATE '1999-04-01' AND activity_date < DATE '1999-07-01'
    GROUP BY ALL
    """,
)
def semantic_relative_range(t: Tables) -> DataFrame:
    request = MetricRequest(
        "sales_order",
        ("order_count",),
        ("order_status",),
        time="activity_date",
        grain="month",
        time_range=TimeRange("last_quarter"),
    )
    return metrics.metric_query(
        sales_model(), request, _sources(t), scope=scope.unrestricted("definition_validation"), today=TODAY
    )


@query(
    "semantic_prior_period",
    f"""
    SELECT order_status, sales, sales_previous, order_count, order_count_previous,
           (sales - sales_previous) * 100.0 / abs(sales_previous) AS sales_change_pct,
           cast(order_count - order_count_previous AS double) * 100.0 / abs(cast(order_count_previous AS double))
             AS order_count_change_pct
    FROM (
      SELECT order_status,
        cast(sum(CASE WHEN cur THEN cast(gross_booked_amount AS decimal(18,2)) END) AS double) AS sales,
        cast(sum(CASE WHEN NOT cur THEN cast(gross_booked_amount AS decimal(18,2)) END) AS double) AS sales_previous,
        count(DISTINCT CASE WHEN cur THEN order_id END) AS order_count,
        count(DISTINCT CASE WHEN NOT cur THEN order_id END) AS order_count_previous
      FROM (SELECT *, activity_date >= DATE '1999-07-01' AS cur FROM {{sales}} s
            WHERE activity_date >= DATE '1999-04-01' AND activity_date < DATE '1999-10-01') p
      GROUP BY order_status) q
    """,
)
def semantic_prior_period(t: Tables) -> DataFrame:
    request = MetricRequest(
        "sales_order", ("sales", "order_count"), ("order_status",), time="activity_date", grain="quarter"
    )
    return metrics.compare_periods(
        sales_model(), request, _sources(t), scope=scope.unrestricted("definition_validation"),
        today=TODAY, tags=FINANCE,
    )


@query(
    "fiscal_quarter_rollup",
    """
    SELECT fiscal_year, fiscal_quarter, fiscal_period, quarter_start, year_start, week_start,
           count(*) AS orders FROM (
      SELECT CASE WHEN month(d) >= 4 THEN year(d) + 1 ELSE year(d) END AS fiscal_year,
             cast((((month(d) + 8) % 12) // 3) + 1 AS integer) AS fiscal_quarter,
             cast(((month(d) + 8) % 12) + 1 AS integer) AS fiscal_period,
             cast(date_trunc('quarter', d) AS date) AS quarter_start,
             CASE WHEN month(d) >= 4 THEN make_date(year(d), 4, 1) ELSE make_date(year(d) - 1, 4, 1) END AS year_start,
             d - cast((isodow(d) % 7) AS integer) AS week_start
      FROM (SELECT cast(o_orderdate AS date) AS d FROM {orders}) x) y
    GROUP BY ALL
    """,
)
def fiscal_quarter_rollup(t: Tables) -> DataFrame:
    calendar = FiscalCalendar(start_month=4, week_start=6)
    day = F.col("o_orderdate").cast("date")
    return t.orders.groupBy(
        calendar.fiscal_year(day).alias("fiscal_year"),
        calendar.quarter(day).alias("fiscal_quarter"),
        calendar.period(day).alias("fiscal_period"),
        calendar.truncated(day, "quarter").alias("quarter_start"),
        calendar.truncated(day, "year").alias("year_start"),
        calendar.truncated(day, "week").alias("week_start"),
    ).agg(F.count(F.lit(1)).alias("orders"))


@query(
    "semantic_fiscal_grain",
    f"""
    SELECT CASE WHEN ((month(d) + 10) % 12) < 3 AND month(d) >= 2 THEN make_date(year(d), 2, 1)
                WHEN ((month(d) + 10) % 12) < 6 AND month(d) >= 2 THEN make_date(year(d), 5, 1)
                WHEN ((month(d) + 10) % 12) < 9 AND month(d) >= 2 THEN make_date(year(d), 8, 1)
                WHEN month(d) = 1 THEN make_date(year(d) - 1, 11, 1)
                ELSE make_date(year(d), 11, 1) END AS activity_date,
           cast(sum(cast(v AS decimal(18,2))) AS double) AS sales
    FROM (SELECT activity_date AS d, gross_booked_amount AS v FROM {{sales}} s) x GROUP BY 1
    """,
)
def semantic_fiscal_grain(t: Tables) -> DataFrame:
    request = MetricRequest("sales_order", ("sales",), time="activity_date", grain="quarter")
    return metrics.metric_query(
        sales_model(2), request, _sources(t), tags=FINANCE, scope=scope.unrestricted("definition_validation")
    )


@query(
    "scope_predicate",
    f"SELECT c_custkey, scope_unit_id FROM {{accounts}} WHERE scope_unit_id IN {_IN_EVEN}",
)
def scope_predicate(t: Tables) -> DataFrame:
    return even_units().apply(t.accounts.select("c_custkey", "scope_unit_id"))


@query(
    "scope_grant_expand",
    """
    WITH RECURSIVE reach AS (
      SELECT scope_unit_id FROM {units} u WHERE scope_unit_id IN ('area-1', 'unit-3')
      UNION SELECT u.scope_unit_id FROM {units} u JOIN reach r ON u.parent_scope_unit_id = r.scope_unit_id)
    SELECT scope_unit_id, count(c_custkey) AS accounts
    FROM reach LEFT JOIN {accounts} a USING (scope_unit_id) GROUP BY scope_unit_id
    """,
)
def scope_grant_expand(t: Tables) -> DataFrame:
    grants = t.units.where(F.col("scope_unit_id").isin("area-1", "unit-3"))
    reached = scope.expand_grants(grants, t.units)
    accounts = t.accounts.groupBy("scope_unit_id").agg(F.count("c_custkey").alias("n"))
    return reached.join(accounts, "scope_unit_id", "left").select(
        "scope_unit_id", F.coalesce("n", F.lit(0)).alias("accounts")
    )


@query(
    "scope_effective_units",
    """
    SELECT scope_unit_id FROM {units} WHERE active
      AND (effective_from IS NULL OR effective_from <= DATE '2001-03-01')
      AND (effective_to IS NULL OR effective_to >= DATE '2001-03-01')
    """,
)
def scope_effective_units(t: Tables) -> DataFrame:
    return scope.effective_units(t.units, date(2001, 3, 1)).select("scope_unit_id")


@query(
    "scope_stamp",
    """
    SELECT scope_unit_id, count(*) AS rows FROM (
      SELECT CASE WHEN lower(trim(raw)) IN (SELECT scope_unit_id FROM {units} u)
                  THEN lower(trim(raw)) END AS scope_unit_id
      FROM (SELECT CASE WHEN s_suppkey % 6 = 0 THEN '  UNIT-' || cast(s_nationkey AS string) || ' '
                        WHEN s_suppkey % 6 = 1 THEN 'Unit-' || cast(s_nationkey + 1000 AS string)
                        WHEN s_suppkey % 6 = 2 THEN '' ELSE 'unit-' || cast(s_nationkey AS string) END AS raw
            FROM {supplier}) x) y GROUP BY scope_unit_id
    """,
)
def scope_stamp(t: Tables) -> DataFrame:
    raw = t.sql(
        """SELECT s_suppkey, CASE WHEN s_suppkey % 6 = 0 THEN '  UNIT-' || cast(s_nationkey AS string) || ' '
             WHEN s_suppkey % 6 = 1 THEN 'Unit-' || cast(s_nationkey + 1000 AS string)
             WHEN s_suppkey % 6 = 2 THEN '' ELSE 'unit-' || cast(s_nationkey AS string) END AS owner_ref
           FROM {supplier}"""
    )
    stamped = scope.stamp_scope(raw, scope.Attribution(field="owner_ref"), t.units)
    return stamped.groupBy("scope_unit_id").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "scope_unattributed_rate",
    """
    SELECT count(*) AS total_rows, count(*) - count(brand_code) AS unattributed_rows,
           100.0 * (count(*) - count(brand_code)) / count(*) AS unattributed_rate_pct,
           100.0 * (count(*) - count(brand_code)) / count(*) > 5 AS exceeds
    FROM {accounts}
    """,
)
def scope_unattributed_rate(t: Tables) -> DataFrame:
    stamped = scope.stamp_scope(t.accounts, scope.Attribution(field="brand_code"))
    return scope.unattributed_rate(stamped)


@query(
    "scope_backfill",
    """
    SELECT order_year, rows, rows_attributed, rows - rows_attributed AS rows_unattributable,
           CASE WHEN rows = rows_attributed THEN 'stamped' ELSE 'ambiguous' END AS outcome,
           CASE WHEN rows = rows_attributed THEN rows ELSE 0 END AS rows_written
    FROM (SELECT year(o_orderdate) AS order_year, count(*) AS rows,
                 count(CASE WHEN NOT (year(o_orderdate) % 3 = 0 AND o_orderkey % 10 = 0) THEN 1 END) AS rows_attributed
          FROM {orders} GROUP BY 1) x
    """,
)
def scope_backfill(t: Tables) -> DataFrame:
    history = t.sql(
        """SELECT year(o_orderdate) AS order_year, o_orderkey,
                  CASE WHEN year(o_orderdate) % 3 = 0 AND o_orderkey % 10 = 0 THEN cast(NULL AS string)
                       ELSE 'unit-' || cast(o_custkey % 25 AS string) END AS owner_ref
           FROM {orders}"""
    )
    written, report = scope.backfill_scope(
        history, "order_year", scope.Attribution(field="owner_ref"), t.units
    )
    per_year = written.groupBy("order_year").agg(F.count(F.lit(1)).alias("n"))
    return report.join(per_year, "order_year", "left").select(
        "order_year", "rows", "rows_attributed", "rows_unattributable", "outcome",
        F.coalesce("n", F.lit(0)).alias("rows_written"),
    )


@query(
    "scope_backfill_nulls",
    """
    SELECT o_orderstatus AS status, rows, CASE WHEN bad = 0 THEN rows ELSE 0 END AS rows_written
    FROM (SELECT CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS o_orderstatus, count(*) AS rows,
                 count(CASE WHEN o_orderstatus = 'F' AND o_orderkey % 10 = 0 THEN 1 END) AS bad FROM {orders} GROUP BY 1) x
    """,
)
def scope_backfill_nulls(t: Tables) -> DataFrame:
    """A partition with a null value and rows without an owner is left alone like any other."""
    history = t.sql(
        """SELECT CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS status, o_orderkey,
                  CASE WHEN NOT (o_orderstatus = 'F' AND o_orderkey % 10 = 0)
                       THEN 'unit-' || cast(o_custkey % 25 AS string) END AS owner_ref
           FROM {orders}"""
    )
    written, report = scope.backfill_scope(history, "status", scope.Attribution(field="owner_ref"), t.units)
    kept = written.groupBy(F.col("status").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    return report.join(kept, F.col("status").eqNullSafe(F.col("s")), "left").select(
        "status", "rows", F.coalesce("n", F.lit(0)).alias("rows_written")
    )


@query(
    "brand_validation",
    """
    SELECT brand_code, count(*) AS rows FROM {accounts}
    WHERE brand_code IS NOT NULL AND brand_code NOT IN ('brand-0', 'brand-1') GROUP BY brand_code
    """,
)
def brand_validation(t: Tables) -> DataFrame:
    registry = (
        t.part.select(F.concat(F.lit("brand-"), (F.col("p_partkey") % 2).cast("string")).alias("brand_code"))
        .distinct()
        .withColumn("active", F.lit(True))
    )
    return scope.unknown_brands(t.accounts, registry)


@query(
    "row_security_view",
    """
    SELECT c_custkey, scope_unit_id, brand_code FROM {accounts}
    WHERE scope_unit_id IN ('unit-1', 'unit-2', 'unit-5') AND (brand_code IS NULL OR brand_code = 'brand-1')
    """,
)
def row_security_view(t: Tables) -> DataFrame:
    rows = t.accounts.select("c_custkey", "scope_unit_id", "brand_code")
    return scope.row_security(rows, ["unit-1", "unit-2", "unit-5"], ["brand-1"])


@query(
    "unit_views",
    """
    SELECT scope_unit_id, count(*) AS rows FROM {accounts}
    WHERE scope_unit_id IN ('unit-4', 'unit-7') GROUP BY scope_unit_id
    """,
)
def unit_views(t: Tables) -> DataFrame:
    names = scope.unit_views({"accounts": t.accounts}, ["unit-4", "unit-7"], "demo")
    both = t.spark.table(names[0]).unionByName(t.spark.table(names[1]))
    return both.groupBy("scope_unit_id").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "governed_view",
    """
    SELECT industry, brand_code, scope_unit_id, count(*) AS rows FROM {accounts} GROUP BY ALL
    """,
)
def governed_view(t: Tables) -> DataFrame:
    view = metrics.governed_view(sales_model().entity("company"), t.accounts, frozenset())
    return view.groupBy(*view.columns).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "small_cell_suppression",
    """
    SELECT service_line, scope_unit_id, CASE WHEN n >= 30 THEN n END AS order_count
    FROM (SELECT service_line, scope_unit_id, count(DISTINCT order_id) AS n FROM {sales} GROUP BY ALL) x
    """,
)
def small_cell_suppression(t: Tables) -> DataFrame:
    model = sales_model()
    names = ("order_count",)
    request = MetricRequest("sales_order", names, ("service_line", "scope_unit_id"))
    rows = metrics.metric_query(model, request, _sources(t), scope=scope.unrestricted("definition_validation"))
    return metrics.suppress_small_cells(rows, metrics.count_metrics(model.entity("sales_order"), names), 30)


@query(
    "peer_benchmark",
    f"""
    SELECT order_status, cohort_size, average, total, median_value, lowest, highest FROM (
      SELECT order_status, count(*) AS cohort_size, avg(v) AS average,
             cast(sum(cast(v AS decimal(18,2))) AS double) AS total, median(v) AS median_value,
             min(v) AS lowest, max(v) AS highest
      FROM (SELECT order_status, scope_unit_id, {_SUM.format('gross_booked_amount')} AS v FROM {{sales}} s
            GROUP BY ALL) u GROUP BY order_status) x WHERE cohort_size - 1 >= 5
    """,
)
def peer_benchmark_query(t: Tables) -> DataFrame:
    request = MetricRequest("sales_order", ("sales",), ("order_status", "scope_unit_id"))
    per_unit = metrics.metric_query(
        sales_model(), request, _sources(t), tags=FINANCE, scope=scope.unrestricted("definition_validation")
    )
    shown = peer_benchmark(
        per_unit, "sales", ["order_status"], {"sum", "median", "min", "max"}, viewer_units=["unit-1"], scale=2
    )
    mean = peer_benchmark(per_unit, "sales", ["order_status"], {"average"}, viewer_units=["unit-1"], scale=2)
    return shown.join(mean.select("order_status", "average"), "order_status").select(
        "order_status", "cohort_size", "average", F.col("sum").alias("total"),
        F.col("median").alias("median_value"), F.col("min").alias("lowest"), F.col("max").alias("highest"),
    )


@query(
    "peer_rank",
    f"""
    SELECT order_status, scope_unit_id, sales,
           cast(rank() OVER (PARTITION BY order_status ORDER BY sales DESC) AS integer) AS rank,
           percent_rank() OVER (PARTITION BY order_status ORDER BY sales) * 100.0 AS percentile
    FROM (SELECT order_status, scope_unit_id, {_SUM.format('gross_booked_amount')} AS sales
          FROM {{sales}} s GROUP BY ALL) x
    """,
)
def peer_rank(t: Tables) -> DataFrame:
    request = MetricRequest("sales_order", ("sales",), ("order_status", "scope_unit_id"))
    per_unit = metrics.metric_query(
        sales_model(), request, _sources(t), tags=FINANCE, scope=scope.unrestricted("definition_validation")
    )
    return peer_benchmark(per_unit, "sales", ["order_status"], {"rank", "percentile"}, viewer_units=[])


@query(
    "restatement_diff",
    f"""
    SELECT activity_date, value_before, value_after, 'sales' AS metric FROM (
      SELECT cast(date_trunc('year', activity_date) AS date) AS activity_date,
        {_SUM.format('gross_booked_amount')} AS value_before,
        {_SUM.format("CASE WHEN order_status <> 'P' OR activity_date >= DATE '1999-01-01' THEN gross_booked_amount END")} AS value_after
      FROM {{sales}} s GROUP BY 1) x WHERE value_before IS DISTINCT FROM value_after
    """,
)
def restatement_diff(t: Tables) -> DataFrame:
    request = MetricRequest("sales_order", ("sales",), time="activity_date", grain="year")
    model, anyone = sales_model(), scope.unrestricted("definition_validation")
    before = metrics.metric_query(model, request, _sources(t), tags=FINANCE, scope=anyone)
    booked = t.sales.where((F.col("order_status") != "P") | (F.col("activity_date") >= F.lit(date(1999, 1, 1))))
    after = metrics.metric_query(model, request, {"sales_order": booked}, tags=FINANCE, scope=anyone)
    return metrics.restatement(before, after, ["activity_date"], "sales")
