"""Session settings, the shared working folder and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_LOCAL_CONF = "tarnlake.local.dir"
_SHIPPED_CONF = "tarnlake.shipped"
STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app_name: str = "tarnlake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the operators are written for.

    Adaptive execution coalesces small shuffle partitions and splits skewed join partitions at run
    time. Leave ``shuffle_partitions`` unset on a cluster and size it there with
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum``; the pair comparisons of matching
    use ``spark.sql.shuffle.partitions`` tasks. Streaming state lives in RocksDB, outside the heap.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(STATE_STORE_CONF, ROCKSDB)
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Give every Python worker of the session this package, once per Spark application.

    The sources go as one zip through ``addPyFile``, so that functions inside Arrow and pandas steps
    resolve on executors that have neither the package installed nor the driver's folders.
    """
    context = spark.sparkContext
    if spark.conf.get(_SHIPPED_CONF, None) == context.applicationId:
        return spark
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tarnlake-zip-"), "tarnlake_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    spark.conf.set(_SHIPPED_CONF, context.applicationId)
    return spark


def shared_base(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without the setting gets a folder of its own; a cluster session
    without it is an error, because a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or context.getConf().get(CHECKPOINT_CONF)
    if configured:
        return configured.rstrip("/")
    current = context.getCheckpointDir()
    if current:
        return os.path.dirname(current.rstrip("/"))
    local = spark.conf.get(_LOCAL_CONF, None)
    if local:
        return local
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    base = tempfile.mkdtemp(prefix="tarnlake-")
    spark.conf.set(_LOCAL_CONF, base)
    return base


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, for a table one job writes and reads."""
    return f"{shared_base(spark)}/{label}-{uuid.uuid4().hex}"


#: Folders of the open runs of ``working_tables``, the innermost last.
_RUNS: list[list[str]] = []


@contextmanager
def working_tables(spark: SparkSession) -> Iterator[None]:
    """Remove the working tables of a run when it ends, also by an error.

    Everything that ``cut_lineage`` writes inside the block goes; what is to stay must be written
    elsewhere before its end, since results are read from these tables when they are used.
    """
    made: list[str] = []
    _RUNS.append(made)
    try:
        yield
    finally:
        _RUNS.remove(made)
        for path in made:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write the rows to a table in the shared folder and read them back.

    Like a reliable checkpoint the result survives the loss of executors; being columnar it also
    keeps column pruning and size statistics for the plans that read it. ``drop_work`` removes the
    tables that are no longer read.
    """
    path = work_path(df.sparkSession, label)
    if _RUNS:
        _RUNS[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_work(*tables: DataFrame) -> None:
    """Remove working tables that nothing reads any more; only paths of the shared folder go."""
    for table in tables:
        spark = table.sparkSession
        base = shared_base(spark).split("://")[-1]
        for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            if base.lstrip("/") in folder:
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
