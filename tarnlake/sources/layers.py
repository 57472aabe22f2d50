"""Reading the storage layers: Parquet layers, landed files, databases, SQL over views."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VIEW_NAME = re.compile(r"^[a-zA-Z_][a-zA-Z0-9_]{0,63}$")
FIELD_MODES = ("all", "standard", "custom", "includeOnly")


def read_layer(
    spark: SparkSession, path: str, schema: T.StructType | None = None, merge_schema: bool = False
) -> DataFrame:
    """A Parquet layer; ``merge_schema`` for raw data whose columns grew over time."""
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column directly below a path, from one folder listing, in text order."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def latest_run(spark: SparkSession, path: str, columns: list[str]) -> DataFrame | None:
    """Rows of the greatest partition, column by column in text order; None without data.

    Only the folders on the way are listed, and only the chosen one is read, however many runs the
    layer has kept.
    """
    chosen = path.rstrip("/")
    for column in columns:
        values = partition_values(spark, chosen, column)
        if not values:
            return None
        chosen = f"{chosen}/{column}={values[-1]}"
    return spark.read.option("basePath", path).parquet(chosen)


def latest_curated(spark: SparkSession, path: str) -> DataFrame | None:
    """Latest run of the latest date of a curated entity; None on the first run."""
    return latest_run(spark, path, ["curated_date", "run_id"])


def latest_analytics(spark: SparkSession, path: str) -> DataFrame | None:
    return latest_run(spark, path, ["analytics_date"])


def register_views(spark: SparkSession, inputs: Mapping[str, DataFrame | str]) -> None:
    """Bind names to DataFrames or Parquet paths."""
    for name, source in inputs.items():
        if not _VIEW_NAME.match(name):
            raise ValueError(f"bad view name {name!r}")
        df = spark.read.parquet(source) if isinstance(source, str) else source
        df.createOrReplaceTempView(name)


def run_sql(
    spark: SparkSession, sql: str, inputs: Mapping[str, DataFrame | str], args: list | dict | None = None
) -> DataFrame:
    """SQL over named inputs with bound parameters, positional or by name."""
    register_views(spark, inputs)
    return spark.sql(sql, args=args)


def read_twins(spark: SparkSession, path: str, run_id: str) -> tuple[DataFrame, DataFrame]:
    """Twins and edges of a published run; lookups by id read one partition of each."""
    return tuple(
        spark.read.parquet(f"{path}/{name}").where(F.col("run_id") == run_id) for name in ("twins", "edges")
    )


def select_fields(
    df: DataFrame,
    mode: str = "all",
    include: tuple[str, ...] = (),
    exclude: tuple[str, ...] = (),
    custom: tuple[str, ...] = (),
) -> DataFrame:
    """Columns by mode, then without the excluded ones. ``custom`` names the custom fields."""
    if mode not in FIELD_MODES:
        raise ValueError(f"unknown field mode {mode!r}")
    chosen = {
        "all": lambda c: True,
        "standard": lambda c: c not in custom,
        "custom": lambda c: c in custom,
        "includeOnly": lambda c: c in include,
    }[mode]
    columns = [c for c in df.columns if chosen(c) and c not in exclude]
    if not columns:
        raise ValueError("no field is selected")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    columns: list[str],
    watermark: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    slices: list[str] | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table or a half-open watermark window of it.

    ``slices`` are watermark bounds inside the window; every slice becomes one task with its own
    predicate, so the read is parallel and the database filters.
    """
    for name in [table, *columns, *([watermark] if watermark else [])]:
        if not re.match(r"^[A-Za-z_][A-Za-z0-9_.]{0,127}$", name):
            raise ValueError(f"bad identifier {name!r}")
    properties = dict(options or {})
    if watermark is None:
        return spark.read.jdbc(url, table, properties=properties).select(*columns)
    if lower is None or upper is None:
        raise ValueError("a watermark read needs both bounds")
    predicates = watermark_predicates(watermark, lower, upper, slices)
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties).select(*columns)


def watermark_predicates(
    watermark: str, lower: str, upper: str, slices: list[str] | None = None
) -> list[str]:
    """Predicates that cover [lower, upper) once, cut at the given bounds."""
    moment = re.compile(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?)?$")
    edges = [lower, *sorted(s for s in slices or [] if lower < s < upper), upper]
    for edge in edges:
        if not moment.match(edge):
            raise ValueError(f"bad watermark bound {edge!r}")
    return [f"{watermark} >= '{a}' AND {watermark} < '{b}'" for a, b in zip(edges, edges[1:])]


class RowCountMismatch(ValueError):
    """A bulk result does not hold the rows its job reported."""


def read_bulk_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, expected_rows: int | None = None
) -> DataFrame:
    """Header CSV of a bulk job, checked against the row count the job reported."""
    df = spark.read.option("header", "true").option("multiLine", "false").schema(schema).csv(path)
    if expected_rows is not None:
        found = df.agg(F.count(F.lit(1))).first()[0]
        if found != expected_rows:
            raise RowCountMismatch(f"{found} rows instead of {expected_rows}")
    return df


def read_nested_json(
    spark: SparkSession,
    path: str,
    records_path: str,
    schema: T.StructType | str,
    unwrap: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Records of a list nested in landed JSON, such as ``data.items``.

    ``unwrap`` takes one field of each list item as the record. Items without it are left out.
    """
    df = spark.read.schema(schema).option("multiLine", str(multi_line).lower()).json(path)
    rows = df.select(F.explode(F.col(records_path)).alias("item"))
    record: Column = F.col(f"item.{unwrap}") if unwrap else F.col("item")
    return rows.select(record.alias("record")).where(F.col("record").isNotNull()).select("record.*")
