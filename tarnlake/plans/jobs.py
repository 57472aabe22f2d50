"""Whole jobs: raw to current state, records to golden entities, golden entities to twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tarnlake.operators import clusters, connecting, graph, mapping, masking, matching, merge, quality, scope
from tarnlake.operators import survivorship
from tarnlake.operators.matching import RECORD_ID
from tarnlake.session import cut_lineage
from tarnlake.sources.keyed_layer import KeyedLayer, Merged


# ---------------------------------------------------------------- raw to current state


@dataclass(frozen=True)
class TransformSpec:
    """Everything the transformation of one entity is configured with."""

    rules: tuple[mapping.MappingRule, ...] | None
    keys: tuple[str, ...]
    order: tuple[str, ...]
    attribution: scope.Attribution
    checks: tuple[quality.RecordCheck, ...] = ()
    batch_policy: quality.BatchPolicy | None = None
    masks: tuple[masking.FieldMask, ...] | None = None
    soft_delete: str | None = None
    strict: bool = False
    secret: bytes | None = None


@dataclass(frozen=True)
class Transformed:
    """Result of a transformation; ``curated`` is None when publication is blocked."""

    curated: DataFrame | None
    rejected: DataFrame
    violations: DataFrame
    outcomes: DataFrame | None
    blocked: bool


def _stage(
    raw: DataFrame, spec: TransformSpec, known_units: DataFrame | None
) -> tuple[DataFrame, Transformed]:
    """Map, mask, check and stamp one delta in a single pass, which is the staging write.

    The totals of record checks, batch checks and attribution are observed by that write. Only the
    duplicate rate reads the staged rows again, and of them the natural key alone.
    """
    tagged = mapping.map_tagged(raw, spec.rules, spec.strict)
    targets = [c for c in tagged.columns if c not in (mapping.RAW, mapping.REASON)]
    policy = spec.masks if spec.masks is not None else masking.auto_policy(targets)
    accepted = F.col(mapping.REASON) == ""
    rows = quality.with_violations(masking.apply_masks(tagged, policy, spec.secret), spec.checks)
    measures = quality.record_counts(accepted)
    if spec.batch_policy is not None:
        rows = quality.with_orphan_flags(rows, spec.batch_policy, accepted)
        measures |= quality.batch_counts(rows, spec.batch_policy, accepted)
    rows = scope.stamp_scope(rows, spec.attribution, known_units)
    measures["unattributed_rows"] = F.count_if(accepted & F.col(scope.SCOPE_COLUMN).isNull())
    seen = Observation()
    staged = cut_lineage(rows.observe(seen, *[c.alias(n) for n, c in measures.items()]), "staged")
    totals = seen.get

    good = staged.where(accepted).select(*[c for c in targets if c != scope.SCOPE_COLUMN], scope.SCOPE_COLUMN)
    keys = [k for k in spec.keys if k in targets]
    violations = staged.where(accepted).select(*keys, F.explode("_violations").alias("_found"))
    rejected = staged.where(~accepted).select(
        f"{mapping.RAW}.*", F.col(mapping.REASON).alias("reject_reason")
    )
    blocked, outcomes = totals["records_blocked"] > 0, None
    if spec.batch_policy is not None:
        if spec.batch_policy.natural_key:
            groups = quality.duplicate_groups(good, list(spec.batch_policy.natural_key))
            extra = groups.agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0))).first()[0]
            totals = {**totals, "duplicates": extra}
        numbers = {n: int(v) for n, v in totals.items()}
        one = raw.sparkSession.createDataFrame(
            [tuple(numbers.values())], ", ".join(f"{n} long" for n in numbers)
        )
        outcomes = quality.batch_outcomes(one, spec.batch_policy)
        gate = quality.batch_gate(outcomes, spec.batch_policy.mode)
        blocked = bool(gate.select("blocked").first()[0]) or blocked
    if not blocked and not spec.attribution.single and totals["total_records"]:
        rate = 100.0 * totals["unattributed_rows"] / totals["total_records"]
        if rate > scope.UNATTRIBUTED_LIMIT_PCT:
            raise ValueError(f"{rate:.2f}% of the rows have no owner; not publishing")
    result = Transformed(None, rejected, violations.select(*keys, "_found.*"), outcomes, blocked)
    return good, result


def transform(
    raw: DataFrame,
    spec: TransformSpec,
    previous: DataFrame | None = None,
    known_units: DataFrame | None = None,
) -> Transformed:
    """Map, mask, check, merge and stamp one delta; the raw rows are read once.

    Masks default to those the field names call for. A tenant with units fails when too many rows
    cannot be attributed.
    """
    rows, result = _stage(raw, spec, known_units)
    if result.blocked:
        return result
    current = merge.merge_current(previous, rows, list(spec.keys), list(spec.order), spec.soft_delete)
    return replace(result, curated=current)


def transform_into(
    layer: KeyedLayer, raw: DataFrame, spec: TransformSpec, known_units: DataFrame | None = None
) -> tuple[Transformed, Merged | None]:
    """``transform``, merged into a keyed layer: only the buckets of the delta's keys are rewritten.

    A blocked delta leaves the layer as it is.
    """
    rows, result = _stage(raw, spec, known_units)
    if result.blocked:
        return result, None
    merged = layer.merge(rows, list(spec.order), spec.soft_delete)
    return replace(result, curated=layer.read()), merged


def reprocess(
    source: DataFrame,
    day_column: str,
    start: date,
    end: date,
    rebuild: Callable[[DataFrame], DataFrame],
    path: str,
) -> None:
    """Rebuild the days of a window under new rules, replacing exactly their partitions.

    The layer at ``path`` is partitioned by ``day_column``; days outside the window are not touched,
    and running it again gives the same result. Rows are rebalanced by day before the write, so a
    day has few files and adaptive execution still splits a very large one.
    """
    window = source.where((F.col(day_column) >= F.lit(start)) & (F.col(day_column) <= F.lit(end)))
    (
        rebuild(window)
        .hint("rebalance", F.col(day_column))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day_column)
        .parquet(path)
    )


# ---------------------------------------------------------------- records to golden entities


@dataclass(frozen=True)
class Resolution:
    """Results of one resolution run."""

    links: DataFrame
    membership: DataFrame
    golden: DataFrame
    conflicts: DataFrame


def resolve_entities(
    records: DataFrame,
    rules: matching.MatchRules,
    policy: survivorship.Survivorship,
    run_id: str,
) -> Resolution:
    """Match, cluster and merge tagged records into golden records.

    The clustering compares only what it does not know to be connected; ``links``, for the audit, are
    all of them, found when they are read. The winners are checkpointed because golden rows and
    conflict log read them.
    """
    links = matching.match_links(records, rules)
    membership = cut_lineage(connecting.clustered_records(records, rules))
    ids = clusters.golden_ids(membership, rules.entity_type)
    winners = cut_lineage(survivorship.resolve_fields(records.join(membership, RECORD_ID), policy))
    return Resolution(
        links,
        membership.join(ids.select("cluster", "golden_id"), "cluster"),
        survivorship.golden_records(winners, ids, policy, run_id),
        survivorship.conflict_log(winners, ids, policy),
    )


# ---------------------------------------------------------------- golden entities to twins


def build_twins(
    golden: DataFrame,
    entity_type: str,
    relationships: list[tuple[graph.Relationship, DataFrame]],
    lifecycle_field: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Edge table over all relationships, and the twins built from it."""
    parts = [graph.edges(rule, golden, target) for rule, target in relationships]
    edge_table = cut_lineage(reduce(DataFrame.unionByName, parts))
    return edge_table, graph.build_twins(golden, edge_table, entity_type, lifecycle_field)
