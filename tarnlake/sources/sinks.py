"""Writing the storage layers, exports and serving tables."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions.hashing import row_hash
from tarnlake.operators.graph import BUCKET_COLUMN, id_bucket
from tarnlake.operators.merge import changed_rows
from tarnlake.operators.scope import SCOPE_COLUMN, ScopeFilter
from tarnlake.operators.survivorship import flatten_lists
from tarnlake.sources.keyed_layer import KeyedLayer, Merged

# Columns that stay inside the resolution layer.
INTERNAL_COLUMNS = (
    "_record_id", "_source_id", "contributing_source_records", "survivorship_version",
    "match_run_id", "field_provenance",
)
EXPORT_FORMATS = ("csv", "json", "parquet")


_IDENTIFIER = re.compile(r"^[A-Za-z_][A-Za-z0-9_.]{0,127}$")


class EmptyWrite(ValueError):
    """A layer that must not be written empty has no rows."""


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The row count comes from the write itself, not from a second pass."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _written(seen: Observation, message: str, allow_empty: bool = False) -> int:
    rows = seen.get["rows"]
    if rows == 0 and not allow_empty:
        raise EmptyWrite(message)
    return rows


def as_raw(df: DataFrame) -> DataFrame:
    """Every column as text; nulls stay."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def write_raw(
    df: DataFrame,
    path: str,
    extraction_date: str,
    run_id: str,
    rows_per_file: int | None = None,
    order_by: str | None = None,
) -> int:
    """Append a run's rows as text; returns the row count. A run without rows writes no file.

    ``order_by`` writes files that follow each other in the order of a column, such as the
    watermark. ``rows_per_file`` limits the size of a file.
    """
    rows = df
    if order_by is not None:
        rows = df.repartitionByRange(F.col(order_by)).sortWithinPartitions(order_by)
    counted, seen = _counted(as_raw(rows))
    tagged = counted.withColumn("extraction_date", F.lit(extraction_date)).withColumn("run_id", F.lit(run_id))
    writer = tagged.write.mode("append").partitionBy("extraction_date", "run_id")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", str(rows_per_file))
    writer.parquet(path)
    return seen.get["rows"]


def write_curated(
    df: DataFrame, path: str, curated_date: date, run_id: str, allow_empty: bool = False
) -> int:
    """Write a full current-state snapshot into its date and run partition.

    The count comes from the write. An empty snapshot touches no partition, so it is refused after
    the write without harm and without a second run of the plan.
    """
    counted, seen = _counted(df)
    (
        counted.withColumn("curated_date", F.lit(curated_date.isoformat()))
        .withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("curated_date", "run_id")
        .parquet(path)
    )
    return _written(seen, "a curated snapshot has no rows", allow_empty)


def materialise(df: DataFrame, path: str) -> int:
    """Write a query result as Parquet; returns its row count."""
    counted, seen = _counted(df)
    counted.write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def publish_golden(
    golden: DataFrame, links: DataFrame, membership: DataFrame, path: str, golden_date: date, run_id: str
) -> int:
    """Golden rows with lists as JSON, the match decisions, and the full membership."""
    counted, seen = _counted(flatten_lists(golden))
    (
        counted.withColumn("golden_date", F.lit(golden_date.isoformat()))
        .withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("golden_date", "run_id")
        .parquet(f"{path}/golden")
    )
    written = _written(seen, "no golden records")
    for name, rows in (("decisions", links), ("membership", membership)):
        (
            rows.withColumn("run_id", F.lit(run_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_id")
            .parquet(f"{path}/{name}")
        )
    return written


def publish_twins(twins: DataFrame, edges: DataFrame, path: str, run_id: str) -> int:
    """Twins and their edges as tables partitioned by a checksum of the node id.

    A lookup reads one partition of either table (``layers.read_twins``). Within a partition the
    rows are sorted by node, so the statistics of the files prune further.
    """
    counted, seen = _counted(twins)
    for name, rows, node in (("twins", counted, "golden_id"), ("edges", edges, "from_golden_id")):
        (
            rows.withColumn(BUCKET_COLUMN, id_bucket(F.col(node)))
            .hint("rebalance", F.col(BUCKET_COLUMN))
            .sortWithinPartitions(BUCKET_COLUMN, node)
            .withColumn("run_id", F.lit(run_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_id", BUCKET_COLUMN)
            .parquet(f"{path}/{name}")
        )
    return _written(seen, "no twins")


def publish_analytics(golden: DataFrame, path: str, analytics_date: date) -> int:
    """Write the day's analytics partition without the internal columns, replacing it if present."""
    counted, seen = _counted(golden.drop(*INTERNAL_COLUMNS))
    (
        counted.withColumn("analytics_date", F.lit(analytics_date.isoformat()))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("analytics_date")
        .parquet(path)
    )
    return _written(seen, "nothing to publish")


def export(
    df: DataFrame, path: str, fmt: str, scope: ScopeFilter, scope_column: str = SCOPE_COLUMN
) -> int:
    """Write the caller's rows as CSV, JSON Lines or Parquet; the filter is part of the export."""
    if fmt not in EXPORT_FORMATS:
        raise ValueError(f"unknown export format {fmt!r}")
    if scope.units is not None and scope_column not in df.columns:
        raise ValueError(f"rows without {scope_column} cannot be exported under a scope")
    counted, seen = _counted(scope.apply(df, scope_column))
    if fmt == "csv":
        flatten_lists(counted).write.mode("errorifexists").option("header", "true").csv(path)
    elif fmt == "json":
        counted.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
    else:
        counted.write.mode("errorifexists").option("compression", "snappy").parquet(path)
    return seen.get["rows"]


def write_jdbc_staging(df: DataFrame, url: str, table: str, options: Mapping[str, str] | None = None) -> None:
    """Changed rows into a staging table, from which the database merges in one transaction."""
    df.write.mode("overwrite").option("truncate", "true").jdbc(url, table, properties=dict(options or {}))


def jdbc_merge_statement(table: str, staging: str, keys: list[str], columns: list[str], dialect: str) -> str:
    """The statement with which the database takes over the rows of its staging table.

    ``mysql`` and ``postgresql`` upsert on the key's unique index; ``sqlserver`` merges. Rows whose
    ``_row_hash`` is unchanged are not in the staging table and stay as they are.
    """
    for name in (table, staging, *keys, *columns):
        if not _IDENTIFIER.match(name):
            raise ValueError(f"bad identifier {name!r}")
    if not keys or not set(keys) <= set(columns):
        raise ValueError("keys must be among the columns")
    rest = [c for c in columns if c not in keys]
    listed = ", ".join(columns)
    read = f"SELECT {listed} FROM {staging}"
    if dialect == "mysql":
        changes = ", ".join(f"{c} = VALUES({c})" for c in rest or keys[:1])
        return f"INSERT INTO {table} ({listed}) {read} ON DUPLICATE KEY UPDATE {changes}"
    if dialect == "postgresql":
        changes = ", ".join(f"{c} = EXCLUDED.{c}" for c in rest)
        action = f"DO UPDATE SET {changes}" if rest else "DO NOTHING"
        return f"INSERT INTO {table} ({listed}) {read} ON CONFLICT ({', '.join(keys)}) {action}"
    if dialect == "sqlserver":
        same = " AND ".join(f"t.{k} = s.{k}" for k in keys)
        changes = ", ".join(f"t.{c} = s.{c}" for c in rest)
        update = f" WHEN MATCHED THEN UPDATE SET {changes}" if rest else ""
        values = ", ".join(f"s.{c}" for c in columns)
        return (
            f"MERGE INTO {table} AS t USING {staging} AS s ON {same}{update} "
            f"WHEN NOT MATCHED THEN INSERT ({listed}) VALUES ({values});"
        )
    raise ValueError(f"unknown dialect {dialect!r}")


_LOCATION = re.compile(r"^s3://[A-Za-z0-9][A-Za-z0-9._/=-]*/$")
_ROLE = re.compile(r"^arn:[a-z0-9:/_+=,.@-]+$", re.IGNORECASE)
_TYPE = re.compile(r"^[A-Za-z][A-Za-z ]*(\(\d+(,\d+)?\))?$")


def bulk_load_statements(
    table: str, staging: str, keys: list[str], columns: Mapping[str, str], location: str, role: str
) -> list[str]:
    """Statements with which a Redshift table takes over Parquet files, to run in one transaction.

    The files are those of an export with ``_row_hash``: a copy into a temporary table, the removal of
    its rows that are stored with the same hash, and a merge of the rest. ``columns`` gives the types.
    """
    names = [*columns, "_row_hash"]
    for name in (table, staging, *keys, *names):
        if not _IDENTIFIER.match(name):
            raise ValueError(f"bad identifier {name!r}")
    if not keys or not set(keys) <= set(columns):
        raise ValueError("keys must be among the columns")
    if not all(_TYPE.match(kind) for kind in columns.values()):
        raise ValueError("bad column type")
    if not _LOCATION.match(location) or not _ROLE.match(role):
        raise ValueError("bad location or role")
    typed = ", ".join(f"{n} {kind}" for n, kind in {**columns, "_row_hash": "VARCHAR(64)"}.items())
    same = " AND ".join(f"{table}.{k} = {staging}.{k}" for k in keys)
    changes = ", ".join(f"{n} = {staging}.{n}" for n in names if n not in keys)
    values = ", ".join(f"{staging}.{n}" for n in names)
    return [
        f"CREATE TEMP TABLE {staging} ({typed})",
        f"COPY {staging} ({', '.join(names)}) FROM '{location}' IAM_ROLE '{role}' FORMAT AS PARQUET",
        f"DELETE FROM {staging} USING {table} WHERE {same} AND {table}._row_hash = {staging}._row_hash",
        f"MERGE INTO {table} USING {staging} ON {same} WHEN MATCHED THEN UPDATE SET {changes} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(names)}) VALUES ({values})",
    ]


def load_serving(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: list[str],
    columns: list[str],
    soft_delete: str | None = None,
    bucket_bytes: int = 256 << 20,
) -> Merged:
    """Bring a serving table up to date: only new and changed rows replace stored ones.

    The table is a ``KeyedLayer``. Row hashes are compared with the rows of the incoming keys alone,
    and only the buckets of rows that differ are rewritten.
    """
    layer = KeyedLayer(spark, path, keys, bucket_bytes)
    names = list(dict.fromkeys([*columns, *([soft_delete] if soft_delete else [])]))
    hashed = incoming.select(*names).withColumn("_row_hash", row_hash(names))
    target = layer.read_near(incoming)
    staged = hashed if target is None else changed_rows(hashed, target, keys, names)
    return layer.merge(staged, ["_row_hash"], soft_delete)


def read_serving(spark: SparkSession, path: str, keys: list[str]) -> DataFrame | None:
    """The rows of a serving table kept by ``load_serving``."""
    rows = KeyedLayer(spark, path, keys).read()
    return None if rows is None else rows.drop("_row_hash")
