"""Streaming queries: the given events read as a stream, results read back as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.registry.base import Tables, derived, query
from tarnlake.session import work_path
from tarnlake.sources.keyed_layer import KeyedLayer
from tarnlake.streaming import events, ordered

derived(
    "inbound",
    """
    SELECT event_id, ts, event_type, user_id, value, 'demo' AS tenant_code, 'conn-' || cast(user_id % 3 AS string) AS connection_id,
           'shop' AS source_id,
           chr(123) || CASE WHEN event_id % 3 = 0 THEN '"ref":"' || cast(event_id AS string) || '","type":"' || event_type
                WHEN event_id % 3 = 1 THEN '"eventId":"e' || cast(event_id AS string) || '","objectType":"Order.' || event_type
                ELSE '"id":"m' || cast(event_id AS string) END || '"' || chr(125) AS body
    FROM {events}
    """,
)
_IDENTIFIED = """
    SELECT *, CASE event_id % 3 WHEN 0 THEN sha256(body) WHEN 1 THEN 'e' || cast(event_id AS string) ELSE 'm' || cast(event_id AS string) END AS eid,
           CASE event_id % 3 WHEN 0 THEN 'shop-' || event_type WHEN 1 THEN 'shop-order-' || event_type ELSE 'shop-webhook' END AS entity_id
    FROM {inbound} i
"""


def _read(t: Tables) -> DataFrame:
    """The events table as a stream; event time has to be an instant."""
    given = events.read_files(t.spark, events.one_table(t.path("events")), t.events.schema)
    return given.withColumn("ts", F.col("ts").cast("timestamp"))


def _stream(t: Tables) -> DataFrame:
    """The events as a stream with the columns of ``inbound``."""
    given = _read(t)
    number = F.col("event_id")
    text = number.cast("string")
    body = (
        F.when(number % 3 == 0, F.concat(F.lit('{"ref":"'), text, F.lit('","type":"'), "event_type", F.lit('"}')))
        .when(number % 3 == 1, F.concat(F.lit('{"eventId":"e'), text, F.lit('","objectType":"Order.'), "event_type", F.lit('"}')))
        .otherwise(F.concat(F.lit('{"id":"m'), text, F.lit('"}')))
    )
    return given.withColumns(
        {
            "tenant_code": F.lit("demo"),
            "connection_id": F.concat(F.lit("conn-"), (F.col("user_id") % 3).cast("string")),
            "source_id": F.lit("shop"),
            "body": body,
        }
    ).withColumnRenamed("event_id", "number")


@query(
    "event_identity",
    f"""
    SELECT event_id AS number, eid AS event_id, entity_id,
           'whk-' || substr(sha256(tenant_code || ':' || connection_id || ':' || eid), 1, 24) AS event_key
    FROM ({_IDENTIFIED}) e
    """,
)
def event_identity(t: Tables) -> DataFrame:
    named = events.identify(t.inbound.withColumnRenamed("event_id", "number"))
    return named.select("number", "event_id", "entity_id", "event_key")


@query(
    "stream_dedupe",
    f"SELECT entity_id, count(*) AS events, cast(sum(cast(value AS decimal(18,2))) AS double) AS value FROM ({_IDENTIFIED}) e GROUP BY 1",
)
def stream_dedupe(t: Tables) -> DataFrame:
    copies = F.when(F.col("number") % 10 == 0, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0)))
    repeated = _stream(t).withColumn("copy", F.explode(copies)).drop("copy")
    path = work_path(t.spark, "inbox")
    unique = events.dedupe(events.received(events.identify(repeated)))
    events.append_available(unique, path, work_path(t.spark, "checkpoint"), ["entity_id"])
    return t.spark.read.parquet(path).groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value"),
    )


_LAST = """
    SELECT user_id, event_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM {events}) x WHERE rn = 1
"""


@query("stream_cdc_merge", f"SELECT * FROM ({_LAST}) l WHERE event_type <> 'error'")
def stream_cdc_merge(t: Tables) -> DataFrame:
    changes = _read(t).select(
        "user_id", "event_id", "event_type", "value", "ts", (F.col("event_type") == "error").alias("removed")
    )
    path = work_path(t.spark, "log")
    order = ["ts", "event_id"]
    events.apply_available(changes, work_path(t.spark, "checkpoint"), events.log_changes(path, ["user_id"], order))
    state = events.current_from_log(t.spark.read.parquet(path), ["user_id"], order, "removed")
    return state.select("user_id", "event_id", "event_type", "value")


@query("stream_ordered_apply", f"SELECT * FROM ({_LAST}) l WHERE event_type <> 'error'")
def stream_ordered_apply(t: Tables) -> DataFrame:
    """The events in files of no order, three deliveries of them, and one state per user."""
    inbox, columns = work_path(t.spark, "inbox"), ["user_id", "event_id", "event_type", "value", "ts"]
    given = t.events.withColumns({"ts": F.col("ts").cast("timestamp"), "removed": F.col("event_type") == "error"})
    mixed = given.select(*columns, "removed").repartition(5, F.xxhash64("event_id"))
    mixed.write.parquet(inbox)
    stream = events.read_files(t.spark, inbox, mixed.schema, 2)
    layer = KeyedLayer(t.spark, work_path(t.spark, "layer"), ["user_id"])
    order = ["ts", "event_id"]
    newer = ordered.newer_only(stream, ["user_id"], order, "36500 days")
    apply = ordered.apply_ordered(layer, order, "removed")
    ordered.run_available(newer, work_path(t.spark, "checkpoint"), apply)
    return layer.read().select(*columns[:-1])


@query(
    "stream_tumbling",
    """
    SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS events,
           cast(sum(cast(value AS decimal(18,2))) AS double) AS value FROM {events} GROUP BY 1, 2
    """,
)
def stream_tumbling(t: Tables) -> DataFrame:
    stream = _read(t)
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value")
    daily = events.tumbling(stream, "ts", "1 day", ["event_type"], [F.count(F.lit(1)).alias("events"), total], "2 days")
    path = work_path(t.spark, "daily")
    events.apply_available(daily, work_path(t.spark, "checkpoint"), events.keep_updates(path), "update")
    return events.latest_updates(t.spark.read.parquet(path), ["window_start", "event_type"]).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "events", "value"
    )
