"""The business KPI catalogue and its validation against expected values."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.fiscal import FiscalCalendar
from tarnlake.functions.values import variance_pct
from tarnlake.operators.scope import unrestricted
from tarnlake.plans.metrics import metric_query
from tarnlake.plans.model import (
    Dimension,
    Entity,
    EntityJoin,
    Metric,
    MetricModel,
    MetricRequest,
    TimeDimension,
    TimeRange,
)

# Access tags.
FINANCE = "dept_finance"
OPERATIONS = "dept_operations"
SALES = "dept_sales_marketing"
EXECUTIVE = "tier_executive"
PII = "class_pii"
DEPARTMENTS = frozenset({FINANCE, OPERATIONS, SALES})


def expand_tags(granted: frozenset[str]) -> frozenset[str]:
    """An executive grant includes every department."""
    return granted | DEPARTMENTS if EXECUTIVE in granted else granted


MONEY = 4
_ACTIVITY = TimeDimension("activity_date", "activity_date")

# Entities, their dimensions and metrics. Money is summed with four decimals.
_ENTITIES = (
    Entity(
        "company",
        (
            Dimension("industry", "industry"),
            Dimension("company_type", "company_type"),
            Dimension("country", "country"),
            Dimension("brand_code", "brand_code"),
            Dimension("scope_unit_id", "scope_unit_id"),
        ),
        (
            Metric("customer_count", "count_distinct", "golden_id"),
            Metric("new_customer_count", "count_distinct", "new_customer_golden_id"),
        ),
        (
            _ACTIVITY,
        ),
        (
            EntityJoin("franchisee", "scope_unit_id", "scope_unit_id"),
            EntityJoin("brand", "brand_code", "brand_code"),
        ),
    ),
    Entity(
        "person",
        (
            Dimension("email_domain", "email_domain", tag=PII),
            Dimension("job_role", "job_role"),
            Dimension("brand_code", "brand_code"),
            Dimension("scope_unit_id", "scope_unit_id"),
        ),
        (
            Metric("contact_count", "count_distinct", "golden_id"),
        ),
        (
            _ACTIVITY,
        ),
    ),
    Entity(
        "franchisee",
        (
            Dimension("scope_unit_id", "scope_unit_id"),
            Dimension("franchisee_name", "franchisee_name"),
            Dimension("franchisee_status", "franchisee_status"),
            Dimension("region", "region"),
            Dimension("brand_code", "brand_code"),
        ),
        (
            Metric("franchisee_count", "count_distinct", "scope_unit_id"),
        ),
        (
            _ACTIVITY,
        ),
    ),
    Entity(
        "brand",
        (
            Dimension("brand_code", "brand_code"),
            Dimension("brand_name", "brand_name"),
            Dimension("department", "department"),
        ),
        (
            Metric("brand_count", "count_distinct", "brand_code"),
        ),
    ),
    Entity(
        "location",
        (
            Dimension("location_name", "location_name"),
            Dimension("postal_region", "postal_region"),
            Dimension("brand_code", "brand_code"),
            Dimension("scope_unit_id", "scope_unit_id"),
        ),
        (
            Metric("location_count", "count_distinct", "location_id"),
        ),
    ),
    Entity(
        "lead",
        (
            Dimension("lead_source", "lead_source"),
            Dimension("lead_status", "lead_status"),
            Dimension("campaign_code", "campaign_code"),
            Dimension("brand_code", "brand_code"),
            Dimension("scope_unit_id", "scope_unit_id"),
        ),
        (
            Metric("raw_leads", "count_distinct", "lead_id", tag=SALES),
            Metric("qualified_leads", "count_distinct", "qualified_lead_id", tag=SALES),
            Metric(
                "lead_qualification_rate", kind="ratio", numerator="qualified_leads", denominator="raw_leads", tag=SALES,
            ),
        ),
        (
            _ACTIVITY,
        ),
    ),
    Entity(
        "opportunity",
        (
            Dimension("stage", "stage"),
            Dimension("pipeline", "pipeline"),
            Dimension("is_counted_stage", "is_counted_stage"),
            Dimension("brand_code", "brand_code"),
            Dimension("scope_unit_id", "scope_unit_id"),
        ),
        (
            Metric("open_opportunities", "count_distinct", "opportunity_id", tag=SALES),
            Metric("pipeline_value", "sum", "opportunity_amount", tag=SALES, scale=MONEY),
            Metric("conversions", "count_distinct", "converted_opportunity_id", tag=SALES),
            Metric(
                "conversion_rate", kind="ratio", numerator="conversions", denominator="open_opportunities", tag=SALES,
            ),
        ),
        (
            _ACTIVITY,
        ),
    ),
    Entity(
        "sales_order",
        (
            Dimension("order_status", "order_status"),
            Dimension("service_line", "service_line"),
            Dimension("brand_code", "brand_code"),
            Dimension("scope_unit_id", "scope_unit_id"),
        ),
        (
            Metric("sales", "sum", "gross_booked_amount", tag=FINANCE, scale=MONEY),
            Metric("order_count", "count_distinct", "order_id", tag=FINANCE),
            Metric(
                "average_order_value", kind="ratio", numerator="sales", denominator="order_count", tag=FINANCE,
            ),
        ),
        (
            _ACTIVITY,
        ),
    ),
    Entity(
        "ar_invoice",
        (
            Dimension("invoice_status", "invoice_status"),
            Dimension("currency_code", "currency_code"),
            Dimension("brand_code", "brand_code"),
            Dimension("scope_unit_id", "scope_unit_id"),
        ),
        (
            Metric("revenue", "sum", "recognised_amount", tag=FINANCE, scale=MONEY),
            Metric("collected_revenue", "sum", "cash_received_amount", tag=FINANCE, scale=MONEY),
            Metric("invoiced_amount", "sum", "invoice_total_amount", tag=FINANCE, scale=MONEY),
            Metric(
                "collection_rate", kind="ratio", numerator="collected_revenue", denominator="invoiced_amount", tag=FINANCE,
            ),
        ),
        (
            _ACTIVITY,
            TimeDimension("recognition_date", "revenue_recognition_date", "month"),
        ),
    ),
    Entity(
        "ap_bill",
        (
            Dimension("vendor_name", "vendor_name"),
            Dimension("expense_category", "expense_category"),
            Dimension("brand_code", "brand_code"),
            Dimension("scope_unit_id", "scope_unit_id"),
        ),
        (
            Metric("payables_amount", "sum", "bill_total_amount", tag=FINANCE, scale=MONEY),
        ),
        (
            _ACTIVITY,
        ),
    ),
    Entity(
        "royalty",
        (
            Dimension("royalty_basis", "royalty_basis"),
            Dimension("contract_code", "contract_code"),
            Dimension("brand_code", "brand_code"),
            Dimension("scope_unit_id", "scope_unit_id"),
        ),
        (
            Metric("royalties", "sum", "royalty_amount", tag=FINANCE, scale=MONEY),
            Metric("royalty_base_amount", "sum", "royalty_base_amount", tag=FINANCE, scale=MONEY),
            Metric(
                "effective_royalty_rate", kind="ratio", numerator="royalties", denominator="royalty_base_amount", tag=FINANCE,
            ),
        ),
        (
            _ACTIVITY,
        ),
    ),
    Entity(
        "campaign",
        (
            Dimension("campaign_code", "campaign_code"),
            Dimension("channel", "channel"),
            Dimension("ad_group", "ad_group"),
            Dimension("brand_code", "brand_code"),
            Dimension("scope_unit_id", "scope_unit_id"),
        ),
        (
            Metric("marketing_spend", "sum", "spend_amount", tag=SALES, scale=MONEY),
            Metric("impressions", "sum", "impressions", tag=SALES),
            Metric("clicks", "sum", "clicks", tag=SALES),
            Metric("attributed_leads", "count_distinct", "attributed_lead_id", tag=SALES),
            Metric(
                "attributed_revenue", "sum", "attributed_revenue_amount", tag=SALES, scale=MONEY,
            ),
            Metric("attributed_customers", "count_distinct", "attributed_customer_id", tag=SALES),
            Metric(
                "cost_per_lead", kind="ratio", numerator="marketing_spend", denominator="attributed_leads", tag=SALES,
            ),
            Metric(
                "cost_per_acquisition", kind="ratio", numerator="marketing_spend", denominator="attributed_customers", tag=SALES,
            ),
            Metric(
                "return_on_ad_spend", kind="ratio", numerator="attributed_revenue", denominator="marketing_spend", tag=SALES,
            ),
            Metric(
                "click_through_rate", kind="ratio", numerator="clicks", denominator="impressions", tag=SALES,
            ),
        ),
        (
            _ACTIVITY,
        ),
    ),
    Entity(
        "call",
        (
            Dimension("call_direction", "call_direction"),
            Dimension("call_outcome", "call_outcome"),
            Dimension("call_centre", "call_centre"),
            Dimension("brand_code", "brand_code"),
            Dimension("scope_unit_id", "scope_unit_id"),
        ),
        (
            Metric("call_count", "count_distinct", "call_id", tag=OPERATIONS),
            Metric("answered_calls", "count_distinct", "answered_call_id", tag=OPERATIONS),
            Metric("total_talk_seconds", "sum", "talk_seconds", tag=OPERATIONS),
            Metric(
                "answer_rate", kind="ratio", numerator="answered_calls", denominator="call_count", tag=OPERATIONS,
            ),
        ),
        (
            _ACTIVITY,
        ),
    ),
    Entity(
        "job",
        (
            Dimension("job_status", "job_status"),
            Dimension("service_line", "service_line"),
            Dimension("is_first_time_fix", "is_first_time_fix"),
            Dimension("brand_code", "brand_code"),
            Dimension("scope_unit_id", "scope_unit_id"),
        ),
        (
            Metric("job_count", "count_distinct", "job_id", tag=OPERATIONS),
            Metric("completed_jobs", "count_distinct", "completed_job_id", tag=OPERATIONS),
            Metric(
                "first_time_fix_jobs", "count_distinct", "first_time_fix_job_id", tag=OPERATIONS,
            ),
            Metric(
                "job_completion_rate", kind="ratio", numerator="completed_jobs", denominator="job_count", tag=OPERATIONS,
            ),
            Metric(
                "first_time_fix_rate", kind="ratio", numerator="first_time_fix_jobs", denominator="completed_jobs", tag=OPERATIONS,
            ),
        ),
        (
            _ACTIVITY,
        ),
    ),
    Entity(
        "employee",
        (
            Dimension("employment_status", "employment_status"),
            Dimension("discipline", "discipline"),
            Dimension("brand_code", "brand_code"),
            Dimension("scope_unit_id", "scope_unit_id"),
        ),
        (
            Metric("active_employees", "count_distinct", "employee_id", tag=OPERATIONS),
        ),
        (
            _ACTIVITY,
        ),
    ),
    Entity(
        "contract",
        (
            Dimension("contract_status", "contract_status"),
            Dimension("contract_code", "contract_code"),
            Dimension("brand_code", "brand_code"),
            Dimension("scope_unit_id", "scope_unit_id"),
        ),
        (
            Metric("active_contracts", "count_distinct", "contract_id", tag=FINANCE),
        ),
        (
            _ACTIVITY,
        ),
    ),
    Entity(
        "franchise_performance",
        (
            Dimension("scope_unit_id", "scope_unit_id"),
            Dimension("brand_code", "brand_code"),
        ),
        (
            Metric("franchise_performance_index", "avg", "performance_index", tag=EXECUTIVE),
            Metric("sales_growth_component", "avg", "sales_growth_normalised", tag=EXECUTIVE),
            Metric("delivery_component", "avg", "job_completion_normalised", tag=EXECUTIVE),
            Metric("collection_component", "avg", "collection_rate_normalised", tag=EXECUTIVE),
            Metric("demand_component", "avg", "lead_qualification_normalised", tag=EXECUTIVE),
        ),
        (
            _ACTIVITY,
        ),
    ),
    Entity(
        "customer_acquisition",
        (
            Dimension("acquisition_channel", "acquisition_channel"),
            Dimension("brand_code", "brand_code"),
            Dimension("scope_unit_id", "scope_unit_id"),
        ),
        (
            Metric("new_customers", "count_distinct", "new_customer_id", tag=SALES),
            Metric("acquisition_cost", "sum", "acquisition_cost_amount", tag=SALES, scale=MONEY),
            Metric(
                "customer_acquisition_cost", kind="ratio", numerator="acquisition_cost", denominator="new_customers", tag=SALES,
            ),
        ),
        (
            _ACTIVITY,
        ),
    ),
)

# Named KPIs and the metric each one reads.
KPI_METRICS = {
    "Sales": ("sales_order", "sales"),
    "Revenue": ("ar_invoice", "revenue"),
    "Collected Revenue": ("ar_invoice", "collected_revenue"),
    "Royalties": ("royalty", "royalties"),
    "Leads": ("lead", "qualified_leads"),
    "Opportunities": ("opportunity", "open_opportunities"),
    "Conversions": ("opportunity", "conversions"),
    "Customer Acquisition": ("customer_acquisition", "customer_acquisition_cost"),
    "Franchise Performance": ("franchise_performance", "franchise_performance_index"),
    "Operational KPIs": ("job", "job_completion_rate"),
    "Marketing performance": ("campaign", "return_on_ad_spend"),
}


def business_model(fiscal_start_month: int = 1) -> MetricModel:
    """The eighteen business entities with their metrics, on the tenant's fiscal calendar."""
    return MetricModel(
        _ENTITIES,
        version="business-v1",
        calendar=FiscalCalendar(fiscal_start_month),
    )


@dataclass(frozen=True)
class Expectation:
    """What a KPI should be over a period. Without a value the KPI is only planned."""

    kpi: str
    entity: str
    metric: str
    start: date
    end: date
    expected: str | None = None
    tolerance_pct: float = 0.0
    time: str | None = "activity_date"


def validate_kpis(
    model: MetricModel,
    expectations: list[Expectation],
    sources: Mapping[str, DataFrame],
    tags: frozenset[str],
) -> DataFrame:
    """One row per expectation: outcome, expected, observed, variance.

    Expectations over the same entity, time and period share one aggregation.
    """
    granted = expand_tags(tags)
    batches: dict[tuple, list[Expectation]] = {}
    for e in expectations:
        if e.expected is not None:
            batches.setdefault((e.entity, e.time, e.start, e.end), []).append(e)
    results: list[DataFrame] = []
    spark = next(iter(sources.values())).sparkSession
    for (entity_name, time, start, end), group in batches.items():
        entity = model.entity(entity_name)
        base = sources[entity_name]
        if time is not None:
            day = F.col(entity.time(time).column)
            base = base.where((day >= F.lit(start)) & (day < F.date_add(F.lit(end), 1)))
        metrics = tuple(dict.fromkeys(e.metric for e in group))
        request = MetricRequest(entity_name, metrics)
        needed = frozenset(entity.metric(m).tag for m in metrics if entity.metric(m).tag)
        row = metric_query(
            model,
            request,
            {**sources, entity_name: base},
            tags=granted | needed,
            scope=unrestricted("definition_validation"),
        )
        checks = F.array(
            *[
                F.struct(
                    F.lit(e.kpi).alias("kpi"),
                    F.lit(e.expected).alias("expected"),
                    F.col(e.metric).cast("double").alias("observed"),
                    F.lit(float(e.tolerance_pct)).alias("tolerance_pct"),
                )
                for e in group
            ]
        )
        checked = row.select(F.inline(checks))
        wanted = F.col("expected").try_cast("double")
        variance = variance_pct(wanted, F.col("observed"))
        passed = F.coalesce(variance <= F.col("tolerance_pct"), F.lit(False))
        results.append(
            checked.select(
                "kpi",
                F.when(passed, "passed").otherwise("failed").alias("outcome"),
                "expected",
                "observed",
                variance.alias("variance_pct"),
            )
        )
    planned = [e for e in expectations if e.expected is None]
    for e in planned:
        model.entity(e.entity).metric(e.metric)
    if planned:
        results.append(
            spark.createDataFrame(
                [(e.kpi, "compile_only", None, None, None) for e in planned],
                "kpi string, outcome string, expected string, observed double, variance_pct double",
            )
        )
    return reduce(DataFrame.unionByName, results)

