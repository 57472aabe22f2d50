"""Relationship edges between golden records, and twins: a node with its adjacency."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.operators.scope import SCOPE_COLUMN, ScopeFilter

DEFAULT_PAGE = 50
BUCKETS = 64
BUCKET_COLUMN = "id_bucket"


@dataclass(frozen=True)
class Relationship:
    name: str
    from_entity: str
    to_entity: str
    from_field: str
    to_field: str


def edges(rule: Relationship, from_golden: DataFrame, to_golden: DataFrame) -> DataFrame:
    """Edges of one relationship: golden records whose fields are equal."""
    unit = F.col(SCOPE_COLUMN) if SCOPE_COLUMN in to_golden.columns else F.lit(None).cast("string")
    left = from_golden.where(F.col("golden_id").isNotNull()).select(
        F.col("golden_id").alias("from_golden_id"), F.col(rule.from_field).alias("_key")
    )
    right = to_golden.where(F.col("golden_id").isNotNull()).select(
        F.col("golden_id").alias("to_golden_id"),
        F.col(rule.to_field).alias("_key"),
        unit.alias("to_scope_unit_id"),
    )
    return left.join(right, "_key").select(
        "from_golden_id",
        "to_golden_id",
        "to_scope_unit_id",
        F.lit(rule.name).alias("relationship_type"),
        F.lit(rule.to_entity).alias("to_entity_type"),
    )


def rollups(edge_table: DataFrame) -> DataFrame:
    """``from_golden_id``, number of edges, and a map of edge counts per relationship."""
    counts = edge_table.groupBy("from_golden_id", "relationship_type").agg(
        F.count(F.lit(1)).alias("n")
    )
    entry = F.struct(
        F.concat("relationship_type", F.lit("_count")).alias("key"), F.col("n").alias("value")
    )
    return counts.groupBy("from_golden_id").agg(
        F.sum("n").alias("edge_count"),
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("rollups"),
    )


def build_twins(
    golden: DataFrame,
    edge_table: DataFrame,
    entity_type: str,
    lifecycle_field: str | None = None,
) -> DataFrame:
    """One twin per golden record, with the counts of its edges; records without edges stay.

    The edges themselves stay in the edge table, where ``twin_edges`` reads those of any node.
    """
    counts = rollups(edge_table)
    stage = F.lit(None).cast("string")
    if lifecycle_field is not None and lifecycle_field in golden.columns:
        stage = F.col(lifecycle_field).cast("string")
    unit = F.col(SCOPE_COLUMN).cast("string") if SCOPE_COLUMN in golden.columns else F.lit(None).cast("string")
    nodes = golden.select(
        F.lit(entity_type).alias("entity_type"),
        "golden_id",
        unit.alias(SCOPE_COLUMN),
        stage.alias("lifecycle_stage"),
        F.struct(*golden.columns).alias("attributes"),
    )
    joined = nodes.join(counts, nodes["golden_id"] == counts["from_golden_id"], "left")
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    return joined.select(
        *nodes.columns,
        F.coalesce("edge_count", F.lit(0)).alias("edge_count"),
        F.coalesce("rollups", empty).alias("rollups"),
    )


def id_bucket(golden_id: Column, buckets: int = BUCKETS) -> Column:
    """The partition of a published twin or edge: a checksum of the node's id."""
    return F.pmod(F.crc32(golden_id.cast("binary")), F.lit(buckets)).cast("int")


def _at(df: DataFrame, golden_id: str, column: str) -> DataFrame:
    """The rows of one node; in a published table only its partition is read."""
    rows = df.where(F.col(column) == golden_id)
    if BUCKET_COLUMN not in df.columns:
        return rows
    return rows.where(F.col(BUCKET_COLUMN) == zlib.crc32(golden_id.encode()) % BUCKETS)


def twin_edges(
    edge_table: DataFrame,
    golden_id: str,
    limit: int | None = None,
    after: tuple[str, str] | None = None,
) -> DataFrame:
    """The edges of one node by relationship and target; with ``limit`` one page of them.

    ``after`` is the (relationship type, target id) of the last edge of the page before.
    """
    rows = _at(edge_table, golden_id, "from_golden_id")
    if after is not None:
        place = F.struct("relationship_type", "to_golden_id")
        rows = rows.where(place > F.struct(F.lit(after[0]), F.lit(after[1])))
    if limit is None:
        return rows
    return rows.orderBy("relationship_type", "to_golden_id").limit(limit)


def find_twin(twins: DataFrame, entity_type: str, golden_id: str, scope: ScopeFilter) -> DataFrame:
    """The twin of an id, or no row when it does not exist or is out of scope."""
    return scope.apply(_at(twins, golden_id, "golden_id").where(F.col("entity_type") == entity_type))


def list_twins(twins: DataFrame, entity_type: str, scope: ScopeFilter) -> DataFrame:
    return scope.apply(twins.where(F.col("entity_type") == entity_type))


def page_twins(
    twins: DataFrame,
    entity_type: str,
    scope: ScopeFilter,
    limit: int = DEFAULT_PAGE,
    after: str | None = None,
) -> DataFrame:
    """One page by golden id; pass the last id of a page as ``after`` for the next."""
    if limit < 1:
        raise ValueError("a page holds at least one twin")
    rows = list_twins(twins, entity_type, scope)
    if after is not None:
        rows = rows.where(F.col("golden_id") > after)
    return rows.orderBy("golden_id").limit(limit)
