"""Usage metering, run status, scoped export rows and tenant erasure."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Stages that are billed; stores an erasure has to cover.
BILLABLE_STAGES = ("extraction",)


def usage(audit: DataFrame) -> DataFrame:
    """Billable records and run counts per tenant, month and entity."""
    billable = audit.where(F.col("stage").isin(*BILLABLE_STAGES))
    status = F.lower("status")
    return billable.groupBy(
        "tenant_code", F.date_format("started_at", "yyyy-MM").alias("period"), "entity_id"
    ).agg(
        F.coalesce(F.sum(F.when(status == "success", F.col("record_count"))), F.lit(0))
        .cast("long")
        .alias("records_processed"),
        F.count_if(status == "success").alias("runs_completed"),
        F.count_if(status == "failed").alias("runs_failed"),
    )


def run_summary(audit: DataFrame) -> DataFrame:
    """One row per run: status over its stages, last stage, start and end."""
    status = F.lower("status")
    return audit.groupBy("tenant_code", "run_id").agg(
        F.when(F.count_if(status == "failed") > 0, "failed")
        .when(F.count_if(status != "success") == 0, "success")
        .otherwise("in_progress")
        .alias("status"),
        F.max_by("stage", F.struct("completed_at", "stage")).alias("latest_stage"),
        F.min("started_at").alias("started_at"),
        F.max("completed_at").alias("completed_at"),
        F.count(F.lit(1)).alias("stages"),
    )


class HoldNotAcknowledged(PermissionError):
    """A store is under hold and the erasure request does not say so."""


def erase_tenant(
    tables: dict[str, DataFrame],
    tenant: str,
    holds: dict[str, str] | None = None,
    acknowledged: tuple[str, ...] = (),
    column: str = "tenant_code",
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Rows each store keeps after erasing a tenant, and a report row per store.

    Held stores are left alone and reported; a hold has to be acknowledged beforehand. Write the
    kept rows, then call ``erasure_certificate`` on what the stores hold afterwards.
    """
    holds = holds or {}
    silent = sorted(set(holds) - set(acknowledged))
    if silent:
        raise HoldNotAcknowledged(f"holds on {silent} are not acknowledged")
    kept, reports = {}, []
    for name, df in tables.items():
        mine = F.col(column).eqNullSafe(F.lit(tenant))
        held = name in holds
        kept[name] = df if held else df.where(~mine)
        reports.append(
            df.agg(F.count_if(mine).alias("tenant_rows")).select(
                F.lit(name).alias("store"),
                F.lit("retained_under_hold" if held else "deleted").alias("outcome"),
                (F.lit(0).cast("long") if held else F.col("tenant_rows")).alias("rows_deleted"),
                F.lit(holds.get(name, "")).alias("retention_basis"),
            )
        )
    return kept, reduce(DataFrame.unionByName, reports)


def erasure_certificate(
    report: DataFrame, stores_now: dict[str, DataFrame], tenant: str, column: str = "tenant_code"
) -> DataFrame:
    """Report with the rows still found per store; ``complete`` only if every store is done."""
    found = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count_if(F.col(column).eqNullSafe(F.lit(tenant))).alias("remaining_rows")).select(
                F.lit(name).alias("store"), "remaining_rows"
            )
            for name, df in stores_now.items()
        ],
    )
    joined = report.join(found, "store", "left")
    done = (F.col("outcome") == "retained_under_hold") | (F.col("remaining_rows") == 0)
    verified = joined.withColumn("verified", F.coalesce(done, F.lit(False)))
    total = verified.agg(F.bool_and("verified").alias("complete")).first()
    return verified.withColumn("complete", F.lit(bool(total[0])))
