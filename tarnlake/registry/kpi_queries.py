"""The business KPI catalogue over tables derived for its eighteen entities."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.operators.scope import ScopeFilter, unrestricted
from tarnlake.plans import kpis, metrics
from tarnlake.plans.model import MetricRequest
from tarnlake.registry.base import Tables, derived, query

_BRAND = "'brand-' || cast({} % 3 AS string) AS brand_code"
_UNIT = "'unit-' || cast({} % 25 AS string) AS scope_unit_id"


def _common(key: str, unit: str, day: str | None) -> str:
    text = f"{_BRAND.format(key)}, {_UNIT.format(unit)}"
    return text if day is None else f"{text}, cast({day} AS date) AS activity_date"


_ORDER = _common("o_orderkey", "o_custkey", "o_orderdate")
_LINE = _common("l_orderkey", "l_suppkey", "l_shipdate")
_EVENT = _common("user_id", "user_id", "ts")

derived("kpi_company", f"""SELECT c_mktsegment AS industry, 'b2b' AS company_type, 'n' || cast(c_nationkey AS string) AS country,
    'gid-' || cast(c_custkey % 1000000 AS string) AS golden_id,
    CASE WHEN c_custkey % 4 = 0 THEN 'gid-' || cast(c_custkey AS string) END AS new_customer_golden_id,
    {_common('c_custkey', 'c_nationkey', None)}, DATE '2024-01-01' AS activity_date FROM {{customer}}""")
derived("kpi_person", f"""SELECT 'd' || cast(c_nationkey AS string) || '.test' AS email_domain, c_mktsegment AS job_role,
    'gid-p' || cast(c_custkey AS string) AS golden_id, {_common('c_custkey', 'c_nationkey', None)},
    DATE '2024-01-01' AS activity_date FROM {{customer}}""")
derived("kpi_franchisee", """SELECT 'unit-' || cast(n_nationkey AS string) AS scope_unit_id, n_name AS franchisee_name,
    CASE WHEN n_nationkey % 3 = 0 THEN 'inactive' ELSE 'active' END AS franchisee_status, 'r' || cast(n_regionkey AS string) AS region,
    'brand-' || cast(n_nationkey % 3 AS string) AS brand_code, DATE '2024-01-01' AS activity_date FROM {nation}""")
derived("kpi_brand", """SELECT DISTINCT 'brand-' || cast(p_partkey % 3 AS string) AS brand_code,
    'Brand ' || cast(p_partkey % 3 AS string) AS brand_name, 'retail' AS department FROM {part}""")
derived("kpi_location", f"""SELECT s_suppkey AS location_id, s_name AS location_name, 'z' || cast(s_nationkey AS string) AS postal_region,
    {_common('s_suppkey', 's_nationkey', None)} FROM {{supplier}}""")
derived("kpi_lead", f"""SELECT event_id AS lead_id, CASE WHEN event_type IN ('purchase', 'signup') THEN event_id END AS qualified_lead_id,
    event_type AS lead_source, CASE WHEN value > 50 THEN 'hot' ELSE 'cold' END AS lead_status, 'camp-' || cast(user_id % 7 AS string) AS campaign_code,
    {_EVENT} FROM {{events}}""")
derived("kpi_opportunity", f"""SELECT o_orderkey AS opportunity_id, CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS converted_opportunity_id,
    o_totalprice AS opportunity_amount, o_orderstatus AS stage, o_orderpriority AS pipeline, o_orderstatus <> 'P' AS is_counted_stage,
    {_ORDER} FROM {{orders}}""")
derived("kpi_sales_order", f"""SELECT o_orderkey AS order_id, o_totalprice AS gross_booked_amount, o_orderstatus AS order_status,
    o_orderpriority AS service_line, {_ORDER} FROM {{orders}}""")
derived("kpi_ar_invoice", f"""SELECT l_orderkey AS invoice_id, l_extendedprice * (1 - l_discount) AS recognised_amount,
    CASE WHEN l_linestatus = 'F' THEN l_extendedprice END AS cash_received_amount, l_extendedprice AS invoice_total_amount,
    l_linestatus AS invoice_status, CASE WHEN l_returnflag = 'A' THEN 'EUR' ELSE 'USD' END AS currency_code,
    cast(l_shipdate AS date) AS revenue_recognition_date, {_LINE} FROM {{lineitem}}""")
derived("kpi_ap_bill", f"""SELECT l_extendedprice AS bill_total_amount, 's' || cast(l_suppkey AS string) AS vendor_name,
    l_returnflag AS expense_category, {_LINE} FROM {{lineitem}}""")
derived("kpi_royalty", f"""SELECT o_totalprice * 0.06 AS royalty_amount, o_totalprice AS royalty_base_amount, o_orderpriority AS royalty_basis,
    'c' || cast(o_custkey % 9 AS string) AS contract_code, {_ORDER} FROM {{orders}}""")
derived("kpi_campaign", f"""SELECT 'camp-' || cast(user_id % 7 AS string) AS campaign_code, event_type AS channel, 'ag-' || cast(user_id % 4 AS string) AS ad_group,
    value AS spend_amount, 100 + user_id AS impressions, user_id % 11 AS clicks,
    CASE WHEN event_type = 'signup' THEN event_id END AS attributed_lead_id, CASE WHEN event_type = 'purchase' THEN value * 3 END AS attributed_revenue_amount,
    CASE WHEN event_type = 'purchase' THEN user_id END AS attributed_customer_id, {_EVENT} FROM {{events}}""")
derived("kpi_call", f"""SELECT event_id AS call_id, CASE WHEN event_type <> 'error' THEN event_id END AS answered_call_id,
    cast(floor(value) AS bigint) AS talk_seconds, CASE WHEN user_id % 2 = 0 THEN 'in' ELSE 'out' END AS call_direction,
    event_type AS call_outcome, 'centre-' || cast(user_id % 3 AS string) AS call_centre, {_EVENT} FROM {{events}}""")
derived("kpi_job", f"""SELECT l_orderkey * 10 + l_linenumber AS job_id, CASE WHEN l_linestatus = 'F' THEN l_orderkey * 10 + l_linenumber END AS completed_job_id,
    CASE WHEN l_linestatus = 'F' AND l_returnflag <> 'R' THEN l_orderkey * 10 + l_linenumber END AS first_time_fix_job_id,
    l_linestatus AS job_status, l_returnflag AS service_line, l_returnflag <> 'R' AS is_first_time_fix, {_LINE} FROM {{lineitem}}""")
derived("kpi_employee", f"""SELECT s_suppkey AS employee_id, 'active' AS employment_status, 'd' || cast(s_suppkey % 4 AS string) AS discipline,
    {_common('s_suppkey', 's_nationkey', None)}, DATE '2024-01-01' AS activity_date FROM {{supplier}}""")
derived("kpi_contract", f"""SELECT c_custkey AS contract_id, 'in force' AS contract_status, 'c' || cast(c_custkey % 9 AS string) AS contract_code,
    {_common('c_custkey', 'c_nationkey', None)}, DATE '2024-01-01' AS activity_date FROM {{customer}}""")
derived("kpi_franchise_performance", f"""SELECT o_totalprice / 5000 AS performance_index, o_totalprice / 500000 AS sales_growth_normalised,
    cast(o_custkey % 100 AS double) / 100 AS job_completion_normalised, cast(o_orderkey % 50 AS double) / 50 AS collection_rate_normalised,
    cast(o_orderkey % 20 AS double) / 20 AS lead_qualification_normalised, {_ORDER} FROM {{orders}}""")
derived("kpi_customer_acquisition", f"""SELECT CASE WHEN o_orderkey % 5 = 0 THEN o_custkey END AS new_customer_id, o_totalprice * 0.01 AS acquisition_cost_amount,
    o_orderpriority AS acquisition_channel, {_ORDER} FROM {{orders}}""")

# Check SQL of every entity's metrics, written out.


def _money(column: str) -> str:
    return f"cast(sum(cast({column} AS decimal(18,4))) AS double)"


def _distinct(column: str) -> str:
    return f"count(DISTINCT {column})"


def _mean(column: str) -> str:
    return f"round(avg({column}), 6)"


def _per(top: str, bottom: str) -> str:
    return f"cast({top} AS double) / nullif(cast({bottom} AS double), 0)"


_CHECKS: dict[str, dict[str, str]] = {
    "company": {"customer_count": _distinct("golden_id"), "new_customer_count": _distinct("new_customer_golden_id")},
    "person": {"contact_count": _distinct("golden_id")},
    "franchisee": {"franchisee_count": _distinct("scope_unit_id")},
    "brand": {"brand_count": _distinct("brand_code")},
    "location": {"location_count": _distinct("location_id")},
    "lead": {
        "raw_leads": _distinct("lead_id"),
        "qualified_leads": _distinct("qualified_lead_id"),
        "lead_qualification_rate": _per(_distinct("qualified_lead_id"), _distinct("lead_id")),
    },
    "opportunity": {
        "open_opportunities": _distinct("opportunity_id"),
        "pipeline_value": _money("opportunity_amount"),
        "conversions": _distinct("converted_opportunity_id"),
        "conversion_rate": _per(_distinct("converted_opportunity_id"), _distinct("opportunity_id")),
    },
    "sales_order": {
        "sales": _money("gross_booked_amount"),
        "order_count": _distinct("order_id"),
        "average_order_value": _per(_money("gross_booked_amount"), _distinct("order_id")),
    },
    "ar_invoice": {
        "revenue": _money("recognised_amount"),
        "collected_revenue": _money("cash_received_amount"),
        "invoiced_amount": _money("invoice_total_amount"),
        "collection_rate": _per(_money("cash_received_amount"), _money("invoice_total_amount")),
    },
    "ap_bill": {"payables_amount": _money("bill_total_amount")},
    "royalty": {
        "royalties": _money("royalty_amount"),
        "royalty_base_amount": _money("royalty_base_amount"),
        "effective_royalty_rate": _per(_money("royalty_amount"), _money("royalty_base_amount")),
    },
    "campaign": {
        "marketing_spend": _money("spend_amount"),
        "impressions": "sum(impressions)",
        "clicks": "sum(clicks)",
        "attributed_leads": _distinct("attributed_lead_id"),
        "attributed_revenue": _money("attributed_revenue_amount"),
        "attributed_customers": _distinct("attributed_customer_id"),
        "cost_per_lead": _per(_money("spend_amount"), _distinct("attributed_lead_id")),
        "cost_per_acquisition": _per(_money("spend_amount"), _distinct("attributed_customer_id")),
        "return_on_ad_spend": _per(_money("attributed_revenue_amount"), _money("spend_amount")),
        "click_through_rate": _per("sum(clicks)", "sum(impressions)"),
    },
    "call": {
        "call_count": _distinct("call_id"),
        "answered_calls": _distinct("answered_call_id"),
        "total_talk_seconds": "sum(talk_seconds)",
        "answer_rate": _per(_distinct("answered_call_id"), _distinct("call_id")),
    },
    "job": {
        "job_count": _distinct("job_id"),
        "completed_jobs": _distinct("completed_job_id"),
        "first_time_fix_jobs": _distinct("first_time_fix_job_id"),
        "job_completion_rate": _per(_distinct("completed_job_id"), _distinct("job_id")),
        "first_time_fix_rate": _per(_distinct("first_time_fix_job_id"), _distinct("completed_job_id")),
    },
    "employee": {"active_employees": _distinct("employee_id")},
    "contract": {"active_contracts": _distinct("contract_id")},
    "franchise_performance": {
        "franchise_performance_index": _mean("performance_index"),
        "sales_growth_component": _mean("sales_growth_normalised"),
        "delivery_component": _mean("job_completion_normalised"),
        "collection_component": _mean("collection_rate_normalised"),
        "demand_component": _mean("lead_qualification_normalised"),
    },
    "customer_acquisition": {
        "new_customers": _distinct("new_customer_id"),
        "acquisition_cost": _money("acquisition_cost_amount"),
        "customer_acquisition_cost": _per(_money("acquisition_cost_amount"), _distinct("new_customer_id")),
    },
}
# Sums of whole numbers.
_WHOLE_NUMBERS = ("impressions", "clicks", "total_talk_seconds")
MODEL = kpis.business_model(4)
ALL_TAGS = kpis.expand_tags(frozenset({kpis.EXECUTIVE}))


def _register(entity: str, checks: dict[str, str]) -> None:
    columns = ", ".join(f"{sql} AS {name}" for name, sql in checks.items())

    def run(t: Tables) -> DataFrame:
        request = MetricRequest(entity, tuple(checks), ("brand_code",))
        sources = {entity: getattr(t, f"kpi_{entity}")}
        rows = metrics.metric_query(MODEL, request, sources, tags=ALL_TAGS, scope=unrestricted("definition_validation"))
        means = [m for m in checks if MODEL.entity(entity).metric(m).aggregation == "avg"]
        return rows.withColumns({m: F.round(m, 6) for m in means}) if means else rows

    sql = f"SELECT brand_code, {columns} FROM {{kpi_{entity}}} k GROUP BY brand_code"
    whole = tuple(name for name in checks if name in _WHOLE_NUMBERS)
    query(f"kpi_{entity}", sql, bigint=whole)(run)


for _entity, _checks in _CHECKS.items():
    _register(_entity, _checks)


@query(
    "kpi_company_by_region",
    """
    SELECT f.region AS franchisee_region, b.brand_name AS brand_brand_name, count(DISTINCT golden_id) AS customer_count
    FROM {kpi_company} c LEFT JOIN (SELECT * FROM {kpi_franchisee} x WHERE scope_unit_id IN ('unit-1', 'unit-2', 'unit-3')) f
         ON c.scope_unit_id = f.scope_unit_id
    LEFT JOIN {kpi_brand} b ON c.brand_code = b.brand_code
    WHERE c.scope_unit_id IN ('unit-1', 'unit-2', 'unit-3') GROUP BY ALL
    """,
)
def kpi_company_by_region(t: Tables) -> DataFrame:
    request = MetricRequest(
        "company", ("customer_count",), joined=(("franchisee", "region"), ("brand", "brand_name"))
    )
    sources = {"company": t.kpi_company, "franchisee": t.kpi_franchisee, "brand": t.kpi_brand}
    return metrics.metric_query(MODEL, request, sources, scope=ScopeFilter(("unit-1", "unit-2", "unit-3")))


_YEAR = "activity_date >= DATE '1998-01-01' AND activity_date <= DATE '1998-12-31'"


def _expectation(kpi: str, entity: str, metric: str, expected: str, tolerance: str, where: str = _YEAR) -> str:
    observed = f"(SELECT cast({_CHECKS[entity][metric]} AS double) FROM {{kpi_{entity}}} k WHERE {where})"
    return f"""
    SELECT '{kpi}' AS kpi, CASE WHEN abs(o - {expected}) / {expected} * 100 <= {tolerance} THEN 'passed' ELSE 'failed' END AS outcome,
           '{expected}' AS expected, o AS observed, abs(o - {expected}) / {expected} * 100 AS variance_pct
    FROM (SELECT {observed} AS o) x
    """


_JAN = "activity_date >= DATE '2024-01-01' AND activity_date <= DATE '2024-01-31'"


@query(
    "kpi_validation",
    " UNION ALL ".join(
        [
            _expectation("Sales", "sales_order", "sales", "1000000.0", "5.0"),
            _expectation("Revenue", "ar_invoice", "revenue", "900000000.0", "1000.0"),
            _expectation("Collected Revenue", "ar_invoice", "collected_revenue", "1.0", "0.0"),
            _expectation("Operational KPIs", "job", "job_completion_rate", "0.5", "40.0"),
            _expectation("Marketing performance", "campaign", "return_on_ad_spend", "0.6", "25.0", _JAN),
            "SELECT 'Royalties', 'compile_only', NULL, NULL, NULL",
        ]
    ),
)
def kpi_validation(t: Tables) -> DataFrame:
    start, end = date(1998, 1, 1), date(1998, 12, 31)

    def expect(kpi: str, value: str | None, tolerance: float = 0.0, days=(start, end)) -> kpis.Expectation:
        entity, metric = kpis.KPI_METRICS[kpi]
        return kpis.Expectation(kpi, entity, metric, *days, value, tolerance)

    expectations = [
        expect("Sales", "1000000.0", 5.0),
        expect("Revenue", "900000000.0", 1000.0),
        expect("Collected Revenue", "1.0"),
        expect("Operational KPIs", "0.5", 40.0),
        expect("Marketing performance", "0.6", 25.0, (date(2024, 1, 1), date(2024, 1, 31))),
        expect("Royalties", None),
    ]
    sources = {e.entity: getattr(t, f"kpi_{e.entity}") for e in expectations}
    return kpis.validate_kpis(MODEL, expectations, sources, ALL_TAGS)
