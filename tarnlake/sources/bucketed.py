"""Tables bucketed and sorted by one key, which join and group by that key without an exchange.

Spark knows buckets through its catalog. The layout is also kept beside the data, so that any session
can name the table again from its path.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators.matching import RECORD_ID
from tarnlake.sources import versions

GOLDEN_ID = "golden_id"
MEMBERS = "contributing_source_records"


def _name(path: str) -> str:
    return f"tarnlake_{hashlib.md5(path.encode()).hexdigest()[:16]}"


def write_bucketed(df: DataFrame, path: str, by: str, sort: list[str], buckets: int) -> None:
    """Replace the table at a path. A key of very many rows is written by several tasks."""
    spread = df.hint("rebalance", F.col(by)).sortWithinPartitions(by, *sort)
    writer = spread.write.format("parquet").mode("overwrite").option("path", path)
    writer.bucketBy(buckets, by).sortBy(by, *sort).saveAsTable(_name(path))
    layout = {"by": by, "sort": sort, "buckets": buckets, "columns": df.schema.toDDL()}
    versions.commit_version(df.sparkSession, f"{path}/_layout", 0, layout)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``write_bucketed`` left at a path."""
    if not spark.catalog.tableExists(_name(path)):
        _, layout = versions.latest_version(spark, f"{path}/_layout")
        if layout is None:
            raise FileNotFoundError(f"no bucketed table at {path}")
        order = ", ".join(f"`{c}`" for c in (layout["by"], *layout["sort"]))
        spark.sql(
            f"CREATE TABLE {_name(path)} ({layout['columns']}) USING parquet CLUSTERED BY (`{layout['by']}`) "
            f"SORTED BY ({order}) INTO {layout['buckets']} BUCKETS LOCATION '{path}'"
        )
    return spark.table(_name(path))


def publish_members(
    golden: DataFrame, membership: DataFrame, path: str, run_id: str, buckets: int = 256
) -> None:
    """Golden rows and the records of each, as two tables bucketed by golden id.

    ``membership`` has a row for every record, with its golden id.
    """
    write_bucketed(golden, f"{path}/golden-{run_id}", GOLDEN_ID, [], buckets)
    members = membership.select(GOLDEN_ID, RECORD_ID)
    write_bucketed(members, f"{path}/members-{run_id}", GOLDEN_ID, [RECORD_ID], buckets)


def golden_with_members(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """The golden rows with the sorted list of their records; rows stay in their buckets.

    A list is as long as its cluster. For a cluster too large for one row read ``member_page``.
    """
    members = read_bucketed(spark, f"{path}/members-{run_id}")
    lists = members.groupBy(GOLDEN_ID).agg(F.array_sort(F.collect_list(RECORD_ID)).alias(MEMBERS))
    golden = read_bucketed(spark, f"{path}/golden-{run_id}")
    return golden.hint("merge").join(lists, GOLDEN_ID, "left")


def member_page(
    spark: SparkSession, path: str, run_id: str, golden_id: str, size: int, after: str | None = None
) -> DataFrame:
    """The next records of one golden record in their order; reads its bucket only."""
    members = read_bucketed(spark, f"{path}/members-{run_id}").where(F.col(GOLDEN_ID) == golden_id)
    if after is not None:
        members = members.where(F.col(RECORD_ID) > after)
    return members.orderBy(RECORD_ID).limit(size)
