"""Row ownership: stamping, filters, grants, effectivity, brand and history backfill."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.session import cut_lineage

SCOPE_COLUMN = "scope_unit_id"
BRAND_COLUMN = "brand_code"

# The one unit of an undivided tenant, and the form of a unit id.
IMPLICIT_UNIT = "__tenant__"
UNIT_PATTERN = r"^[a-z_][a-z0-9_\-]{1,63}$"
UNATTRIBUTED_LIMIT_PCT = 5.0

# Levels after which the reached units are written as one table again.
_MERGE_ROUNDS = 16


class ScopeDenied(PermissionError):
    """A claim grants nothing."""


class UnknownUnit(PermissionError):
    """A claim names a unit the tenant does not have."""


@dataclass(frozen=True)
class ScopeClaims:
    """What one caller may see."""

    units: frozenset[str] = frozenset()
    tenant_wide: bool = False
    single: bool = False


@dataclass(frozen=True)
class ScopeFilter:
    """Row filter of one caller; ``units is None`` lets every row through.

    A large grant comes as ``table`` (one column of units) and is joined instead of listed.
    """

    units: tuple[str, ...] | None
    null_allowed: bool = False
    table: DataFrame | None = field(default=None, compare=False)

    def condition(self, column: Column | str = SCOPE_COLUMN) -> Column:
        col = F.col(column) if isinstance(column, str) else column
        if self.units is None:
            return F.lit(True)
        if self.table is not None:
            raise ValueError("a grant table is joined with apply, not used as a condition")
        inside = col.isin(*self.units)
        return (col.isNull() | inside) if self.null_allowed else inside

    def apply(self, df: DataFrame, column: str = SCOPE_COLUMN) -> DataFrame:
        if self.units is None:
            return df
        if self.table is None:
            return df.where(self.condition(column))
        granted = self.table.select(F.col(SCOPE_COLUMN).alias("_granted")).distinct()
        return df.join(granted, F.col(column) == F.col("_granted"), "left_semi")


def scope_filter(claims: ScopeClaims) -> ScopeFilter:
    """Filter for a claim; a claim without any grant is refused, never read as "no filter"."""
    if not claims.tenant_wide and not claims.units:
        raise ScopeDenied("the claim grants no unit and no tenant-wide access")
    if claims.tenant_wide:
        return ScopeFilter(None)
    if IMPLICIT_UNIT in claims.units and not claims.single:
        raise UnknownUnit("the implicit unit exists only for an undivided tenant")
    return ScopeFilter(tuple(sorted(claims.units)), null_allowed=claims.single)


def granted_filter(granted: DataFrame, units: DataFrame) -> ScopeFilter:
    """Filter for granted nodes with everything below them, kept as a table at any size."""
    missing = unknown_grants(granted, units).limit(20).collect()
    if missing:
        raise UnknownUnit(f"unknown units: {sorted(r[0] for r in missing)}")
    known = units.select(SCOPE_COLUMN).distinct()
    reached = expand_grants(granted, units).join(known, SCOPE_COLUMN, "left_semi")
    return ScopeFilter((), table=reached)


def unrestricted(reason: str) -> ScopeFilter:
    """Match-all filter that has to be asked for by name."""
    if reason != "definition_validation":
        raise ValueError(f"no unrestricted read is defined for {reason!r}")
    return ScopeFilter(None)


def expand_grants(grants: DataFrame, units: DataFrame) -> DataFrame:
    """Every unit reachable downwards from the granted nodes, the nodes included.

    ``grants(scope_unit_id)``, ``units(scope_unit_id, parent_scope_unit_id)``. Each round goes one
    level down from the units found last and drops those known before, so a tree of any depth ends,
    as do diamonds and cycles, and a unit counts once. The driver only asks if a round found any.
    """
    below = units.select(
        F.col(SCOPE_COLUMN).alias("_below"), F.col("parent_scope_unit_id").alias(SCOPE_COLUMN)
    ).where(F.col("_below").isNotNull())
    reached = found = cut_lineage(grants.select(SCOPE_COLUMN).distinct())
    rounds = 0
    while True:
        new = found.join(below, SCOPE_COLUMN).select(F.col("_below").alias(SCOPE_COLUMN)).distinct()
        found = cut_lineage(new.join(reached, SCOPE_COLUMN, "left_anti"))
        if found.isEmpty():
            return reached
        reached = reached.unionByName(found)
        rounds += 1
        if rounds % _MERGE_ROUNDS == 0:
            reached = cut_lineage(reached)


def unknown_grants(grants: DataFrame, units: DataFrame) -> DataFrame:
    """Granted nodes the tenant does not have; any row here refuses the claim."""
    return grants.select(SCOPE_COLUMN).distinct().join(units.select(SCOPE_COLUMN), SCOPE_COLUMN, "left_anti")


def build_claims(
    granted: Iterable[str],
    units: DataFrame,
    tenant_wide: bool = False,
    single: bool = False,
    most_units: int = 10_000,
) -> ScopeClaims:
    """Checked claim with hierarchy grants expanded, for a grant short enough to be listed.

    A grant that reaches more than ``most_units`` is refused; ``granted_filter`` takes grants of any
    size and keeps the expanded units as a table.
    """
    if single:
        return ScopeClaims(frozenset({IMPLICIT_UNIT}), tenant_wide, single=True)
    if tenant_wide:
        return ScopeClaims(tenant_wide=True)
    wanted = sorted(set(granted))
    if IMPLICIT_UNIT in wanted:
        raise UnknownUnit("the implicit unit exists only for an undivided tenant")
    if not wanted:
        return ScopeClaims()
    spark = units.sparkSession
    grants = spark.createDataFrame([(g,) for g in wanted], f"{SCOPE_COLUMN} string")
    missing = unknown_grants(grants, units).limit(20).collect()
    if missing:
        raise UnknownUnit(f"unknown units: {sorted(r[0] for r in missing)}")
    known = units.select(SCOPE_COLUMN).distinct()
    reached = expand_grants(grants, units).join(known, SCOPE_COLUMN, "left_semi")
    listed = reached.limit(most_units + 1).collect()
    if len(listed) > most_units:
        raise ScopeDenied(f"the grant reaches more than {most_units} units: use granted_filter")
    return ScopeClaims(frozenset(r[0] for r in listed))


def effective_units(units: DataFrame, day: date) -> DataFrame:
    """Units in force on a day; an open end is unlimited."""
    on = F.lit(day)
    return units.where(
        F.col("active")
        & (F.col("effective_from").isNull() | (F.col("effective_from") <= on))
        & (F.col("effective_to").isNull() | (on <= F.col("effective_to")))
    )


@dataclass(frozen=True)
class Attribution:
    """How the owner of a row is found: undivided tenant, fixed owner, or a field of the row."""

    single: bool = False
    owner: str | None = None
    field: str | None = None

    def candidate(self) -> Column:
        if self.single:
            return F.lit(IMPLICIT_UNIT)
        if self.owner is not None:
            return F.lit(self.owner)
        if self.field is None:
            return F.lit(None).cast("string")
        text = F.lower(F.trim(F.col(f"`{self.field}`").cast("string")))
        valid = text.rlike(UNIT_PATTERN) & (text != IMPLICIT_UNIT)
        return F.when(valid, text)


def stamp_scope(
    df: DataFrame, attribution: Attribution, known_units: DataFrame | None = None
) -> DataFrame:
    """Add ``scope_unit_id``; a row whose unit is not known stays in the result with null."""
    stamped = df.drop(SCOPE_COLUMN).withColumn(SCOPE_COLUMN, attribution.candidate())
    if known_units is None or attribution.field is None or attribution.single or attribution.owner:
        return stamped
    known = known_units.select(F.col(SCOPE_COLUMN).alias("_known_unit")).distinct()
    return (
        stamped.join(known, stamped[SCOPE_COLUMN] == known["_known_unit"], "left")
        .withColumn(SCOPE_COLUMN, F.col("_known_unit"))
        .drop("_known_unit")
    )


def unattributed_rate(df: DataFrame, limit_pct: float = UNATTRIBUTED_LIMIT_PCT) -> DataFrame:
    """One row: rows, rows without owner, rate in percent, and whether the rate is too high."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(SCOPE_COLUMN).isNull()).alias("unattributed_rows"),
    )
    rate = F.when(F.col("total_rows") == 0, 0.0).otherwise(
        100.0 * F.col("unattributed_rows") / F.col("total_rows")
    )
    return counts.withColumn("unattributed_rate_pct", rate).withColumn(
        "exceeds", F.col("unattributed_rate_pct") > limit_pct
    )


def backfill_scope(
    df: DataFrame,
    partition_column: str,
    attribution: Attribution,
    known_units: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Stamp historic partitions that can be attributed completely.

    Returns the stamped rows of those partitions, ready for a dynamic partition overwrite, and a
    report row per partition. A partition with any unattributable row is reported as ambiguous and
    left alone.
    """
    stamped = stamp_scope(df, attribution, known_units)
    report = (
        stamped.groupBy(partition_column)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count(SCOPE_COLUMN).alias("rows_attributed"),
            F.count_if(F.col(SCOPE_COLUMN).isNull()).alias("rows_unattributable"),
        )
        .withColumn(
            "outcome",
            F.when(F.col("rows_unattributable") == 0, "stamped").otherwise("ambiguous"),
        )
    )
    ambiguous = report.where(F.col("outcome") == "ambiguous").select(
        F.col(partition_column).alias("_ambiguous")
    )
    # A partition whose value is null is a partition like any other.
    same = stamped[partition_column].eqNullSafe(F.col("_ambiguous"))
    return stamped.join(ambiguous, same, "left_anti"), report


def stamp_brand(df: DataFrame, brand: str | None) -> DataFrame:
    return df.withColumn(BRAND_COLUMN, F.lit(brand).cast("string"))


def unknown_brands(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Brands used by rows but not registered; an empty registry accepts every brand."""
    used = df.where(~(F.col(BRAND_COLUMN).isNull() | (F.col(BRAND_COLUMN) == ""))).groupBy(
        BRAND_COLUMN
    ).agg(F.count(F.lit(1)).alias("rows"))
    active = registry.where(F.col("active")).select(BRAND_COLUMN).distinct()
    if active.isEmpty():
        return used.where(F.lit(False))
    return used.join(active, BRAND_COLUMN, "left_anti")


def row_security(
    df: DataFrame, units: Iterable[str], brands: Iterable[str] | None = None
) -> DataFrame:
    """Rows of the session's units; a null unit never shows, a null brand always does."""
    allowed = sorted(set(units))
    if not allowed:
        raise ScopeDenied("the session has no units")
    condition = F.col(SCOPE_COLUMN).isin(*allowed)
    if brands is not None:
        listed = sorted(set(brands))
        brand_ok = F.col(BRAND_COLUMN).isNull()
        if listed:
            brand_ok = brand_ok | F.col(BRAND_COLUMN).isin(*listed)
        condition = condition & brand_ok
    return df.where(condition)


def unit_views(tables: dict[str, DataFrame], units: Iterable[str], tenant: str) -> list[str]:
    """Register one filtered view per unit and table; returns the view names."""
    names = []
    for unit in sorted(set(units)):
        if not re.match(UNIT_PATTERN, unit):
            raise ValueError(f"bad unit id {unit!r}")
        for table, df in tables.items():
            name = f"{tenant}_{unit}_{table}".replace("-", "_")
            df.where(F.col(SCOPE_COLUMN) == unit).createOrReplaceTempView(name)
            names.append(name)
    return names
