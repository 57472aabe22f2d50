"""Current-state merges, change detection and merge verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.hashing import row_hash
from tarnlake.functions.values import truthy_text


class MergeError(ValueError):
    """A merge that cannot be expressed safely."""


def check_keys(df: DataFrame, keys: list[str]) -> None:
    if not keys:
        raise MergeError("a merge needs at least one key")
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise MergeError(f"keys {missing} are not columns")


def has_key(keys: list[str]) -> Column:
    """Every key column holds a value."""
    found = F.lit(True)
    for k in keys:
        found = found & F.col(k).isNotNull() & (F.col(k).cast("string") != "")
    return found


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of every key in the given order.

    ``max_by`` combines on the map side, so a key with very many versions never meets in one task
    as it would with a window. Rows equal in all order columns are told apart by a hash of the row.
    """
    others = [c for c in df.columns if c not in keys]
    # Maps have no hash of their own.
    hashed = [F.to_json(f.name) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in df.schema]
    position = F.struct(*[F.col(c) for c in order], F.xxhash64(*hashed).alias("_tie"))
    picked = F.max_by(F.struct(*others), position) if others else F.max(position)
    latest = df.groupBy(*keys).agg(picked.alias("_row"))
    if not others:
        return latest.select(*df.columns)
    return latest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def is_deleted(df: DataFrame, column: str) -> Column:
    """Soft-delete marker; text follows the boolean words of the mapping casts."""
    kind = df.schema[column].dataType.typeName()
    col = F.col(column)
    if kind == "boolean":
        marked = col
    elif kind == "string":
        marked = truthy_text(col)
    else:
        marked = col != 0
    return F.coalesce(marked, F.lit(False))


def merge_current(
    previous: DataFrame | None,
    delta: DataFrame,
    keys: list[str],
    order: list[str],
    soft_delete: str | None = None,
) -> DataFrame:
    """Current state after a delta: keys upserted, last version wins, marked keys removed.

    Delta rows without a key are skipped (``merge_counts`` counts them). The first run, with no
    previous state, follows the same rules. Applying a delta twice changes nothing.
    """
    check_keys(delta, keys)
    latest = latest_per_key(delta.where(has_key(keys)), keys, order)
    return apply_latest(previous, latest, delta, keys, soft_delete)


def apply_latest(
    previous: DataFrame | None,
    latest: DataFrame,
    delta: DataFrame,
    keys: list[str],
    soft_delete: str | None = None,
) -> DataFrame:
    """The state after rows that are already one per key; ``delta`` tells the marker's type."""
    alive = latest.where(~is_deleted(delta, soft_delete)) if soft_delete else latest
    if previous is None:
        return alive
    kept = previous.join(latest.select(*keys), keys, "left_anti")
    return kept.unionByName(alive, allowMissingColumns=True)


def merge_counts(
    delta: DataFrame, merged: DataFrame, keys: list[str], order: list[str], soft_delete: str | None = None
) -> DataFrame:
    """One row: delta rows, rows without key, deleted keys, merged rows."""
    keyed = latest_per_key(delta.where(has_key(keys)), keys, order)
    deleted = F.count_if(is_deleted(delta, soft_delete)) if soft_delete else F.lit(0).cast("long")
    parts = [
        delta.agg(F.count(F.lit(1)).alias("n"), F.count_if(~has_key(keys)).alias("m")).select(
            F.col("n").alias("delta_rows"),
            F.col("m").alias("rows_without_key"),
            F.lit(0).alias("deleted_keys"),
            F.lit(0).alias("merged_rows"),
        ),
        keyed.agg(deleted.alias("d")).select(
            F.lit(0).alias("delta_rows"),
            F.lit(0).alias("rows_without_key"),
            F.col("d").alias("deleted_keys"),
            F.lit(0).alias("merged_rows"),
        ),
        merged.agg(F.count(F.lit(1)).alias("r")).select(
            F.lit(0).alias("delta_rows"),
            F.lit(0).alias("rows_without_key"),
            F.lit(0).alias("deleted_keys"),
            F.col("r").alias("merged_rows"),
        ),
    ]
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return together.agg(*[F.sum(c).cast("long").alias(c) for c in together.columns])


def changed_rows(
    incoming: DataFrame, target: DataFrame, keys: list[str], columns: list[str]
) -> DataFrame:
    """Incoming rows that are new or whose content differs from the target; adds ``_row_hash``.

    Only the keys and hashes of the target take part in the join. ``target`` may already carry
    ``_row_hash`` from its last load; otherwise the hash is computed from the same columns.
    """
    check_keys(incoming, keys)
    hashed = incoming.withColumn("_row_hash", row_hash(columns))
    known = target if "_row_hash" in target.columns else target.withColumn("_row_hash", row_hash(columns))
    return hashed.join(known.select(*keys, "_row_hash"), [*keys, "_row_hash"], "left_anti")


def change_counts(incoming: DataFrame, changed: DataFrame) -> DataFrame:
    """One row: rows to load and rows skipped as unchanged."""
    both = incoming.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(0).cast("long").alias("c")).unionByName(
        changed.agg(F.count(F.lit(1)).alias("c")).select(F.lit(0).cast("long").alias("n"), "c")
    )
    totals = both.agg(F.sum("n").alias("n"), F.sum("c").alias("c"))
    return totals.select(F.col("c").alias("loaded"), (F.col("n") - F.col("c")).alias("skipped"))


def upsert(
    target: DataFrame, staged: DataFrame, keys: list[str], soft_delete: str | None = None
) -> DataFrame:
    """Target after replacing the staged keys, then without the rows marked deleted."""
    check_keys(staged, keys)
    result = target.join(staged.select(*keys).distinct(), keys, "left_anti").unionByName(
        staged.select(*[c for c in target.columns])
    )
    return result.where(~is_deleted(result, soft_delete)) if soft_delete else result


def verify_merge(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: merged rows, distinct keys, and whether they agree."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("merged_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
    ).withColumn("verified", F.col("merged_rows") == F.col("distinct_keys"))
