"""Inbound events: identity, routing, deduplication, ordered apply, change log, time windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarnlake.operators.merge import has_key, is_deleted, latest_per_key

# Names providers use for an event's id and type; memory of seen events.
EVENT_ID_NAMES = ("eventId", "event_id", "id", "messageId")
EVENT_TYPE_NAMES = ("subscriptionType", "objectType", "event_type", "type")
DEDUPE_HOURS = 48
ENTITY_PATTERN = r"^[a-z][a-z0-9\-]{1,63}$"


_BODY = ", ".join(f"{n} string" for n in dict.fromkeys(EVENT_ID_NAMES + EVENT_TYPE_NAMES))


def _first_present(parsed: Column, names: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.nullif(parsed[n], F.lit("")) for n in names])


def event_id(body: Column, parsed: Column) -> Column:
    """The provider's event id, else a hash of the body."""
    return F.coalesce(_first_present(parsed, EVENT_ID_NAMES), F.sha2(body, 256))


def event_key(tenant: Column, connection: Column, event: Column) -> Column:
    return F.concat(
        F.lit("whk-"), F.substring(F.sha2(F.concat_ws(":", tenant, connection, event), 256), 1, 24)
    )


def entity_for(source: Column, parsed: Column) -> Column:
    """Target entity from the event's type; an unusable type goes to the source's inbox."""
    kind = F.lower(F.trim(_first_present(parsed, EVENT_TYPE_NAMES)))
    named = F.concat(source, F.lit("-"), F.translate(kind, "._", "--"))
    inbox = F.concat(source, F.lit("-webhook"))
    return F.when(F.coalesce(named.rlike(ENTITY_PATTERN) & (kind != ""), F.lit(False)), named).otherwise(inbox)


def identify(events: DataFrame) -> DataFrame:
    """Add event id, key and entity to ``(tenant_code, connection_id, source_id, body, ...)``."""
    parsed = events.withColumn("_parsed", F.from_json("body", _BODY))
    named = parsed.withColumns(
        {
            "event_id": event_id(F.col("body"), F.col("_parsed")),
            "entity_id": entity_for(F.col("source_id"), F.col("_parsed")),
        }
    ).drop("_parsed")
    return named.withColumn(
        "event_key", event_key(F.col("tenant_code"), F.col("connection_id"), F.col("event_id"))
    )


RECEIVED_AT = "received_at"


def received(events: DataFrame) -> DataFrame:
    """Add the time of delivery: the start of the micro-batch that brings an event."""
    return events.withColumn(RECEIVED_AT, F.current_timestamp())


def dedupe(events: DataFrame, time: str = RECEIVED_AT, hours: int = DEDUPE_HOURS) -> DataFrame:
    """Drop events seen before, per tenant, connection and event id.

    ``time`` is the time of delivery, not of the event: an event that comes days late for the first
    time is kept. A key is forgotten ``hours`` after its first delivery.
    """
    keys = ["tenant_code", "connection_id", "event_id"]
    return events.withWatermark(time, f"{hours} hours").dropDuplicatesWithinWatermark(keys)


def tumbling(
    events: DataFrame, time: str, width: str, groups: list[str], aggregates: list[Column], late: str
) -> DataFrame:
    """Aggregates per fixed window; events later than ``late`` are left out.

    In append or update mode the state of a window goes once the watermark has passed its end.
    """
    return (
        events.withWatermark(time, late)
        .groupBy(F.window(time, width), *groups)
        .agg(*aggregates)
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "*")
        .drop("window")
    )


# ---------------------------------------------------------------- running


def one_table(path: str) -> str:
    """A path pattern for one table, whether it is a single file or a folder of files."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/{{{name}}}"


def read_files(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.parquet(path)


def append_available(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> StreamingQuery:
    """Write everything available to Parquet and stop; the file sink is exactly-once."""
    writer = df.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.option("checkpointLocation", checkpoint).start(path)
    query.awaitTermination()
    return query


def apply_available(
    df: DataFrame,
    checkpoint: str,
    apply: Callable[[DataFrame, int], None],
    output_mode: str = "append",
) -> StreamingQuery:
    """Run ``apply(batch, batch_id)`` over everything available and stop."""
    query = (
        df.writeStream.foreachBatch(apply)
        .outputMode(output_mode)
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .start()
    )
    query.awaitTermination()
    return query


def keep_updates(path: str) -> Callable[[DataFrame, int], None]:
    """Batch function that stores the rows an update-mode stream changed, by batch."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(path)
        )

    return apply


def latest_updates(log: DataFrame, keys: list[str]) -> DataFrame:
    """The last stored version of every key: the result of the stream so far."""
    return latest_per_key(log, keys, ["batch_id"]).drop("batch_id")


# ---------------------------------------------------------------- change log


def log_changes(path: str, keys: list[str], order: list[str]) -> Callable[[DataFrame, int], None]:
    """Batch function that stores the last version of every key of a batch.

    Each batch overwrites its own ``batch_id`` partition, so a repeated batch changes nothing, and
    its cost depends on the batch alone. Within a key the order columns decide, which keeps events
    of one stream in order.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        latest = latest_per_key(batch.where(has_key(keys)), keys, order)
        (
            latest.withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(path)
        )

    return apply


def current_from_log(
    log: DataFrame,
    keys: list[str],
    order: list[str],
    soft_delete: str | None = None,
    base: DataFrame | None = None,
) -> DataFrame:
    """Current state from a change log and the snapshot it continues; deletions are honoured.

    Write the result as the next snapshot, and drop the batches it covers, to compact.
    """
    changes = latest_per_key(log.drop("batch_id"), keys, order)
    alive = changes.where(~is_deleted(changes, soft_delete)) if soft_delete else changes
    if base is None:
        return alive
    return base.join(changes.select(*keys), keys, "left_anti").unionByName(alive, allowMissingColumns=True)
