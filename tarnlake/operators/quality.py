"""Record checks, batch checks, the quality gate and the exception store."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.values import is_missing, parse_iso_date, rate_pct, redact_key, two_places
from tarnlake.operators.masking import PERSONAL, SENSITIVE, FieldMask

# Default thresholds in percent, earliest plausible date, store limits.
MIN_POPULATED_PCT = 95.0
MAX_DUPLICATE_PCT = 0.5
MAX_ORPHAN_PCT = 1.0
MAX_DATE_ANOMALY_PCT = 0.5
EARLIEST_DATE = date(1990, 1, 1)
FUTURE_DAYS = 1

_VIOLATION = "struct<field_name:string,check_kind:string,severity:string,detail:string>"


# record checks


@dataclass(frozen=True)
class NullCheck:
    field: str
    severity: str = "warning"


@dataclass(frozen=True)
class RangeCheck:
    field: str
    severity: str = "warning"
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class PatternCheck:
    field: str
    pattern: str
    severity: str = "warning"


@dataclass(frozen=True)
class AllowedCheck:
    field: str
    allowed: frozenset[str]
    severity: str = "warning"


RecordCheck = NullCheck | RangeCheck | PatternCheck | AllowedCheck


def _violation(check: RecordCheck, kind: str, detail: Column) -> Column:
    return F.struct(
        F.lit(check.field).alias("field_name"),
        F.lit(kind).alias("check_kind"),
        F.lit(check.severity).alias("severity"),
        detail.alias("detail"),
    )


def _evaluate(df: DataFrame, check: RecordCheck) -> Column:
    """The violation of one check on one row, or null."""
    name = check.field
    value = F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")
    text = value.cast("string")
    if isinstance(check, NullCheck):
        bad = text.isNull() | (F.trim(text) == "")
        return F.when(bad, _violation(check, "null_check", F.lit(f"Field '{name}' is null or empty")))
    if isinstance(check, RangeCheck):
        number = text.try_cast("double")
        detail = F.when(number.isNull(), F.lit(f"Field '{name}' is not numeric"))
        shown = number.cast("string")
        if check.low is not None:
            detail = detail.when(
                number < check.low, F.concat(F.lit("Value "), shown, F.lit(f" < min={check.low}"))
            )
        if check.high is not None:
            detail = detail.when(
                number > check.high, F.concat(F.lit("Value "), shown, F.lit(f" > max={check.high}"))
            )
        return F.when(
            value.isNotNull() & detail.isNotNull(), _violation(check, "range_check", detail)
        )
    if isinstance(check, PatternCheck):
        bad = value.isNotNull() & ~text.rlike(f"^(?:{check.pattern})")
        return F.when(
            bad,
            _violation(check, "pattern_check", F.lit(f"Field '{name}' does not match pattern")),
        )
    bad = value.isNotNull() & ~text.isin(*sorted(check.allowed))
    return F.when(
        bad, _violation(check, "allowed_values", F.lit(f"Field '{name}' value not in allowed set"))
    )


def with_violations(df: DataFrame, checks: Iterable[RecordCheck]) -> DataFrame:
    """Add ``_violations``, the array of failed checks of each row."""
    found = [_evaluate(df, c) for c in checks]
    array = F.array_compact(F.array(*found)) if found else F.array().cast(f"array<{_VIOLATION}>")
    return df.withColumn("_violations", array)


def _has(severity: str) -> Column:
    return F.exists("_violations", lambda v: v["severity"] == severity)


def record_report(df: DataFrame, checks: Iterable[RecordCheck]) -> DataFrame:
    """One row with totals; a row that is both blocked and warned counts as blocked."""
    blocked = _has("blocking")
    counts = with_violations(df, checks).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.size("_violations") == 0).alias("records_passed"),
        F.count_if((F.size("_violations") > 0) & ~blocked).alias("records_with_warnings"),
        F.count_if(blocked).alias("records_blocked"),
        F.coalesce(F.sum(F.size("_violations")), F.lit(0)).cast("long").alias("violations"),
    )
    return counts.withColumn("is_publication_blocked", F.col("records_blocked") > 0)


def record_counts(where: Column) -> dict[str, Column]:
    """Aggregates of the record report over rows with ``_violations``, for a pass that runs anyway."""
    return {
        "total_records": F.count_if(where),
        "records_blocked": F.count_if(where & _has("blocking")),
        "violations": F.coalesce(F.sum(F.when(where, F.size("_violations"))), F.lit(0)).cast("long"),
    }


def record_violations(df: DataFrame, checks: Iterable[RecordCheck], keys: list[str]) -> DataFrame:
    """One row per violation with the keys of its record."""
    found = with_violations(df, checks).select(*keys, F.explode("_violations").alias("_found"))
    return found.select(*keys, "_found.*")


# batch checks: outcome rows (rule_id, measured_value, threshold, passed) and exception rows


@dataclass(frozen=True)
class ForeignKey:
    child: str
    parent_keys: DataFrame
    parent_column: str
    parent_entity: str = "parent"


@dataclass(frozen=True)
class BatchPolicy:
    """What a batch is checked for; a check without parameters is left out."""

    required: tuple[str, ...] = ()
    natural_key: tuple[str, ...] = ()
    date_fields: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    min_populated_pct: float = MIN_POPULATED_PCT
    max_duplicate_pct: float = MAX_DUPLICATE_PCT
    max_orphan_pct: float = MAX_ORPHAN_PCT
    max_anomaly_pct: float = MAX_DATE_ANOMALY_PCT
    today: date | None = None
    severity: str = "warn"
    mode: str = "block"


def _as_date(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType.typeName()
    col = F.col(f"`{name}`")
    return col.cast("date") if kind in ("date", "timestamp", "timestamp_ntz") else parse_iso_date(col)


def populated_counts(df: DataFrame, fields: Iterable[str]) -> dict[str, Column]:
    return {f: F.count_if(~is_missing(F.col(f"`{f}`"))) for f in fields}


def completeness(df: DataFrame, fields: list[str], minimum: float = MIN_POPULATED_PCT) -> DataFrame:
    """Population rate of each required field, from one pass over the rows."""
    total = F.count(F.lit(1))
    pairs = [
        F.struct(
            F.lit(f).alias("field_name"), rate_pct(n, total, 100.0).alias("population_rate_pct")
        )
        for f, n in populated_counts(df, fields).items()
    ]
    return df.agg(F.array(*pairs).alias("r")).select(F.inline("r")).withColumn(
        "passed", F.col("population_rate_pct") >= minimum
    )


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*[F.col(f"`{k}`").alias(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("rows")
    )


def orphans(df: DataFrame, fk: ForeignKey) -> DataFrame:
    """Missing parent keys with the number of child rows that name them.

    Child rows are counted per key before the join, so one hot key is one row of the join.
    """
    child = (
        df.where(~is_missing(F.col(f"`{fk.child}`")))
        .groupBy(F.col(f"`{fk.child}`").cast("string").alias("key"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    parents = fk.parent_keys.select(F.col(fk.parent_column).cast("string").alias("key")).distinct()
    return child.join(parents, "key", "left_anti")


def _date_flags(df: DataFrame, name: str, today: date) -> tuple[Column, Column]:
    day = _as_date(df, name)
    future = F.coalesce(F.date_diff(day, F.lit(today)) > FUTURE_DAYS, F.lit(False))
    early = F.coalesce(day < F.lit(EARLIEST_DATE), F.lit(False))
    return future, early


def date_anomalies(df: DataFrame, fields: Iterable[str], today: date) -> Column:
    """Number of date anomalies of a row, over all date fields."""
    flags = [flag for f in fields for flag in _date_flags(df, f, today)]
    return reduce(lambda a, b: a + b, [f.cast("int") for f in flags])


def with_orphan_flags(df: DataFrame, policy: BatchPolicy, where: Column) -> DataFrame:
    """Add ``_orphan_0`` ...: the row names a parent that does not exist, by declared foreign key.

    The rows stream past the distinct parent keys, so a hot child key can be split.
    """
    for i, fk in enumerate(policy.foreign_keys):
        key, parent = F.col(f"`{fk.child}`"), f"_parent_{i}"
        parents = fk.parent_keys.select(F.col(fk.parent_column).cast("string").alias(parent)).distinct()
        orphan = where & ~is_missing(key) & F.col(parent).isNull()
        joined = df.join(parents, key.cast("string") == F.col(parent), "left")
        df = joined.withColumn(f"_orphan_{i}", orphan).drop(parent)
    return df


def batch_counts(df: DataFrame, policy: BatchPolicy, where: Column) -> dict[str, Column]:
    """Aggregates behind the batch checks, but for duplicates, over rows with orphan flags."""
    counts = {"batch_rows": F.count_if(where)}
    for i, f in enumerate(policy.required):
        counts[f"populated_{i}"] = F.count_if(where & ~is_missing(F.col(f"`{f}`")))
    if policy.date_fields:
        found = date_anomalies(df, policy.date_fields, policy.today or date.today())
        counts["anomalies"] = F.coalesce(F.sum(F.when(where, found)), F.lit(0))
    for i, _ in enumerate(policy.foreign_keys):
        counts[f"orphans_{i}"] = F.count_if(F.col(f"_orphan_{i}"))
    return counts


def batch_outcomes(counts: DataFrame, policy: BatchPolicy) -> DataFrame:
    """``batch_checks`` from one row of ``batch_counts``, with ``duplicates`` for a natural key."""
    total, found = F.col("batch_rows"), []

    def outcome(rule: str, measured: Column, limit: float, passed: Column) -> None:
        found.append(
            F.struct(
                F.lit(rule).alias("rule_id"),
                measured.alias("measured_value"),
                F.lit(float(limit)).alias("threshold"),
                passed.alias("passed"),
            )
        )

    if policy.required:
        rates = [rate_pct(F.col(f"populated_{i}"), total, 100.0) for i, _ in enumerate(policy.required)]
        worst = F.least(*rates) if len(rates) > 1 else rates[0]
        outcome("completeness", worst, policy.min_populated_pct, worst >= policy.min_populated_pct)
    ceilings = [("date-validation", "anomalies", policy.max_anomaly_pct)] if policy.date_fields else []
    if policy.natural_key:
        ceilings.append(("duplicate-rate", "duplicates", policy.max_duplicate_pct))
    ceilings += [
        ("referential-integrity", f"orphans_{i}", policy.max_orphan_pct)
        for i, _ in enumerate(policy.foreign_keys)
    ]
    for rule, name, limit in ceilings:
        rate = rate_pct(F.col(name), total, 0.0)
        outcome(rule, rate, limit, rate <= limit)
    if not found:
        raise ValueError("the policy declares no check")
    return counts.select(F.inline(F.array(*found)))


def batch_checks(df: DataFrame, policy: BatchPolicy) -> DataFrame:
    """Outcome of every declared check: ``rule_id, measured_value, threshold, passed``.

    Completeness and date checks share one pass; duplicates and orphans are a key count each.
    """
    outcomes: list[DataFrame] = []
    total = F.count(F.lit(1))
    single_pass: list[Column] = []
    if policy.required:
        rates = [rate_pct(n, total, 100.0) for n in populated_counts(df, policy.required).values()]
        worst = F.least(*rates) if len(rates) > 1 else rates[0]
        single_pass.append(
            F.struct(
                F.lit("completeness").alias("rule_id"),
                worst.alias("measured_value"),
                F.lit(float(policy.min_populated_pct)).alias("threshold"),
                (worst >= policy.min_populated_pct).alias("passed"),
            )
        )
    if policy.date_fields:
        today = policy.today or date.today()
        found = F.coalesce(F.sum(date_anomalies(df, policy.date_fields, today)), F.lit(0))
        rate = rate_pct(found, total, 0.0)
        single_pass.append(
            F.struct(
                F.lit("date-validation").alias("rule_id"),
                rate.alias("measured_value"),
                F.lit(float(policy.max_anomaly_pct)).alias("threshold"),
                (rate <= policy.max_anomaly_pct).alias("passed"),
            )
        )
    if single_pass:
        outcomes.append(df.agg(F.array(*single_pass).alias("o")).select(F.inline("o")))
    if policy.natural_key:
        groups = duplicate_groups(df, list(policy.natural_key))
        rate = rate_pct(
            F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)),
            F.coalesce(F.sum("rows"), F.lit(0)),
            0.0,
        )
        outcomes.append(_ceiling(groups.agg(rate.alias("measured_value")), "duplicate-rate", policy.max_duplicate_pct))
    for fk in policy.foreign_keys:
        tagged = orphans(df, fk).select(F.col("rows").alias("orphans"), F.lit(0).cast("long").alias("n"))
        rows = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(0).cast("long").alias("orphans"), "n")
        rate = rate_pct(F.sum("orphans"), F.sum("n"), 0.0)
        outcomes.append(
            _ceiling(
                tagged.unionByName(rows).agg(rate.alias("measured_value")),
                "referential-integrity",
                policy.max_orphan_pct,
            )
        )
    if not outcomes:
        raise ValueError("the policy declares no check")
    return reduce(DataFrame.unionByName, outcomes)


def _ceiling(measured: DataFrame, rule: str, limit: float) -> DataFrame:
    return measured.select(
        F.lit(rule).alias("rule_id"),
        "measured_value",
        F.lit(float(limit)).alias("threshold"),
        (F.col("measured_value") <= limit).alias("passed"),
    )


# Exception kinds of the batch checks.
_KINDS = {
    "completeness": "completeness_below_threshold",
    "duplicate-rate": "duplicate_rate_exceeded",
    "referential-integrity": "referential_orphan",
    "date-validation": "date_validation",
}


def batch_exceptions(outcomes: DataFrame, severity: str = "warn") -> DataFrame:
    """One exception row per failed check."""
    kind = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    at_least = F.col("rule_id") == "completeness"
    limit = two_places(F.col("threshold"))
    return outcomes.where(~F.col("passed")).select(
        "rule_id",
        kind[F.col("rule_id")].alias("kind"),
        F.lit(severity).alias("severity"),
        two_places(F.col("measured_value")).alias("observed_value"),
        F.when(at_least, F.concat(F.lit(">="), limit))
        .otherwise(F.concat(F.lit("<="), limit))
        .alias("expected_value"),
    )


def batch_gate(outcomes: DataFrame, mode: str = "block") -> DataFrame:
    """One row: failed checks and whether they block publication."""
    failed = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("rule_id"))))
    return outcomes.agg(
        F.count(F.lit(1)).alias("checks"),
        F.array_join(failed, ",").alias("failed_rules"),
        (F.lit(mode == "block") & (F.count_if(~F.col("passed")) > 0)).alias("blocked"),
    )


def gate_verdict(exceptions: DataFrame, mode: str = "block") -> DataFrame:
    """Verdict over exception severities: any error blocks unless the mode is ``warn``."""
    counts = exceptions.agg(
        F.count_if(F.col("severity").isin("error", "blocking")).alias("blocking_count"),
        F.count_if(F.col("severity").isin("warn", "warning")).alias("warning_count"),
    )
    return counts.withColumn(
        "permitted", (F.col("blocking_count") == 0) | F.lit(mode != "block")
    )


# exception store


def masked_samples(
    samples: DataFrame, column: str, policy: Iterable[FieldMask] | None, key_field: str
) -> DataFrame:
    """Sample keys fit for storage: sensitive ones dropped, personal or unclassified ones redacted."""
    if policy is None:
        return samples.withColumn(column, redact_key(F.col(column)))
    level = {m.column: m.level for m in policy}.get(key_field)
    if level == SENSITIVE:
        return samples.where(F.lit(False))
    if level == PERSONAL:
        return samples.withColumn(column, redact_key(F.col(column)))
    return samples


def exception_sample(violations: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """The first ``limit`` violations by key and field."""
    return violations.orderBy(*keys, "field_name", "check_kind").limit(limit)


def exception_rows(
    violations: DataFrame,
    run: dict[str, str],
    keys: list[str],
    policy: Iterable[FieldMask] | None = None,
) -> DataFrame:
    """Rows for the exception store: every violation of the run, to be stored by run.

    For a short list to show, take ``exception_sample`` of the violations first.
    """
    sample = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    level = {m.column: m.level for m in policy or ()}
    fields = [F.lit(v).alias(k) for k, v in sorted(run.items())]
    if policy is not None and any(level.get(k) == SENSITIVE for k in keys):
        sample = F.lit(None).cast("string")
    elif policy is None or any(level.get(k) == PERSONAL for k in keys):
        sample = redact_key(sample)
    severity = F.when(F.col("severity").isin("blocking", "error"), "error").otherwise("warn")
    return violations.select(
        *fields,
        F.col("check_kind").alias("rule_id"),
        F.lit("quality_violation").alias("kind"),
        severity.alias("severity"),
        F.col("detail").alias("message"),
        F.col("field_name").alias("key_field_name"),
        sample.alias("sample_key"),
    )
