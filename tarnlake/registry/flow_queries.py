"""Graph, schema, incremental, storage, lifecycle and whole-job queries."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.operators import benchmark, graph, incremental, lifecycle, mapping, masking, merge
from tarnlake.operators import matching, quality, schema, scope, survivorship
from tarnlake.plans import jobs
from tarnlake.registry.base import Tables, derived, query
from tarnlake.session import work_path
from tarnlake.sources import bucketed, layers, sinks
from tarnlake.sources.keyed_layer import KeyedLayer

EVERYONE = scope.ScopeFilter(None)

# ---------------------------------------------------------------- graph

derived(
    "golden_company",
    """
    SELECT 'gid-c' || cast(c_custkey AS string) AS golden_id, c_custkey AS customer_key, c_name AS full_name,
           c_mktsegment AS stage, c_nationkey AS nation_key, 'unit-' || cast(c_nationkey AS string) AS scope_unit_id
    FROM {customer}
    """,
)
derived(
    "golden_order",
    """
    SELECT CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE 'gid-o' || cast(o_orderkey AS string) END AS golden_id,
           CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey END AS customer_key, o_orderstatus,
           CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 'unit-' || cast(o_custkey % 25 AS string) END AS scope_unit_id
    FROM {orders}
    """,
)
derived(
    "golden_region",
    """
    SELECT 'gid-n' || cast(n_nationkey AS string) AS golden_id, n_nationkey AS nation_key, n_name,
           'unit-' || cast(n_nationkey AS string) AS scope_unit_id FROM {nation}
    """,
)
PLACED = graph.Relationship("placed", "company", "sales_order", "customer_key", "customer_key")
BASED_IN = graph.Relationship("based_in", "company", "location", "nation_key", "nation_key")

_PLACED = """
    SELECT c.golden_id AS from_golden_id, o.golden_id AS to_golden_id, o.scope_unit_id AS to_scope_unit_id,
           'placed' AS relationship_type, 'sales_order' AS to_entity_type
    FROM {golden_company} c JOIN {golden_order} o ON c.customer_key = o.customer_key WHERE o.golden_id IS NOT NULL
"""
_BASED = """
    SELECT c.golden_id AS from_golden_id, n.golden_id AS to_golden_id, n.scope_unit_id AS to_scope_unit_id,
           'based_in' AS relationship_type, 'location' AS to_entity_type
    FROM {golden_company} c JOIN {golden_region} n ON c.nation_key = n.nation_key
"""


@query("edges_orders_customer", _PLACED)
def edges_orders_customer(t: Tables) -> DataFrame:
    return graph.edges(PLACED, t.golden_company, t.golden_order)


def _twins(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Published twins and edges."""
    edges, twins = jobs.build_twins(
        t.golden_company, "company", [(PLACED, t.golden_order), (BASED_IN, t.golden_region)], "stage"
    )
    path = work_path(t.spark, "twins")
    sinks.publish_twins(twins, edges, path, "run-1")
    return layers.read_twins(t.spark, path, "run-1")


@query(
    "twin_rollups",
    f"""
    SELECT c.golden_id, c.stage AS lifecycle_stage, c.scope_unit_id, coalesce(p, 0) AS placed_count,
           coalesce(b, 0) AS based_in_count, coalesce(p, 0) + coalesce(b, 0) AS edge_count,
           coalesce(p, 0) + coalesce(b, 0) AS listed
    FROM {{golden_company}} c
    LEFT JOIN (SELECT from_golden_id, count(*) AS p FROM ({_PLACED}) e GROUP BY 1) x ON x.from_golden_id = c.golden_id
    LEFT JOIN (SELECT from_golden_id, count(*) AS b FROM ({_BASED}) e GROUP BY 1) y ON y.from_golden_id = c.golden_id
    """,
)
def twin_rollups(t: Tables) -> DataFrame:
    counts = F.col("rollups")

    def count_of(name: str):
        return F.coalesce(F.try_element_at(counts, F.lit(f"{name}_count")), F.lit(0))

    twins, edges = _twins(t)
    listed = edges.groupBy(F.col("from_golden_id").alias("golden_id")).agg(F.count(F.lit(1)).alias("n"))
    return twins.join(listed, "golden_id", "left").select(
        "golden_id", "lifecycle_stage", "scope_unit_id", count_of("placed").alias("placed_count"),
        count_of("based_in").alias("based_in_count"), "edge_count", F.coalesce("n", F.lit(0)).alias("listed"),
    )


_SOME_UNITS = scope.ScopeFilter(("unit-3", "unit-4", "unit-5"))


@query(
    "twin_list",
    "SELECT golden_id, scope_unit_id FROM {golden_company} WHERE scope_unit_id IN ('unit-3', 'unit-4', 'unit-5')",
)
def twin_list(t: Tables) -> DataFrame:
    return graph.list_twins(_twins(t)[0], "company", _SOME_UNITS).select("golden_id", "scope_unit_id")


@query(
    "twin_lookup",
    f"""
    SELECT g.golden_id, e.relationship_type, e.to_golden_id, e.to_scope_unit_id
    FROM (SELECT max(golden_id) AS golden_id FROM {{golden_company}} x) g
    JOIN (SELECT * FROM ({_PLACED}) p UNION ALL SELECT * FROM ({_BASED}) b) e ON e.from_golden_id = g.golden_id
    """,
)
def twin_lookup(t: Tables) -> DataFrame:
    last = t.golden_company.agg(F.max("golden_id")).first()[0]
    twins, edges = _twins(t)
    found = graph.find_twin(twins, "company", last, EVERYONE).select("golden_id")
    return found.join(graph.twin_edges(edges, last), F.col("golden_id") == F.col("from_golden_id")).select(
        "golden_id", "relationship_type", "to_golden_id", "to_scope_unit_id"
    )


@query(
    "twin_page",
    """
    SELECT golden_id FROM {golden_company} WHERE golden_id > 'gid-c12' AND scope_unit_id IN ('unit-3', 'unit-4', 'unit-5')
    ORDER BY golden_id LIMIT 20
    """,
)
def twin_page(t: Tables) -> DataFrame:
    return graph.page_twins(_twins(t)[0], "company", _SOME_UNITS, 20, "gid-c12").select("golden_id")


# ---------------------------------------------------------------- alerts

_MONTHLY = """
    SELECT cast(date_trunc('month', activity_date) AS date) AS month, order_status,
           cast(sum(cast(gross_booked_amount AS decimal(18,2))) AS double) AS sales, count(*) AS orders
    FROM {sales} s GROUP BY ALL
"""


def _monthly(t: Tables) -> DataFrame:
    return t.sales.groupBy(F.trunc("activity_date", "MONTH").alias("month"), "order_status").agg(
        F.sum(F.col("gross_booked_amount").cast("decimal(18,2)")).cast("double").alias("sales"),
        F.count(F.lit(1)).alias("orders"),
    )


_CHANGES = f"""
    SELECT month, order_status, sales, orders, sales_previous, orders >= 10 AS condition_1,
           coalesce(sales_previous <> 0 AND abs(sales - sales_previous) / abs(sales_previous) * 100.0 > 15, false) AS condition_2
    FROM (SELECT *, lag(sales) OVER (PARTITION BY order_status ORDER BY month) AS sales_previous FROM ({_MONTHLY}) m) x
"""


@query("metric_alerts", f"SELECT *, condition_1 AND condition_2 AS fires FROM ({_CHANGES}) c")
def metric_alerts(t: Tables) -> DataFrame:
    rows = benchmark.with_previous(_monthly(t), "sales", "month", ["order_status"])
    conditions = [
        benchmark.AlertCondition("orders", "gte", 10),
        benchmark.AlertCondition("sales", "changed_by_pct_above", 15),
    ]
    return benchmark.evaluate_alerts(rows, conditions, {"sales": "sales_previous"})


# ---------------------------------------------------------------- schema

derived(
    "part_before",
    """
    SELECT p_partkey, p_name, cast(p_size AS string) AS p_size, p_brand, p_type,
           cast(p_retailprice AS decimal(12,2)) AS p_retailprice FROM {part}
    """,
)
derived(
    "part_after",
    """
    SELECT p_partkey, CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_name || '!' END AS p_name, p_size, p_brand,
           cast(p_retailprice AS decimal(14,4)) AS p_retailprice, p_partkey % 2 = 0 AS is_even FROM {part}
    """,
)
_NAME_LENGTH = "(SELECT cast(max(length(p_name)) AS string) FROM {part_before} b)"
_NEW_LENGTH = "(SELECT cast(max(length(p_name)) AS string) FROM {part_after} a)"
_SIZE_LENGTH = "(SELECT cast(max(length(p_size)) AS string) FROM {part_before} b)"
_DRIFT = f"""
    SELECT 'p_type' AS field_name, 'removed' AS change_kind, 'breaking' AS classification,
           'string' AS previous_value, cast(NULL AS string) AS current_value
    UNION ALL SELECT 'is_even', 'added', 'breaking', NULL, 'boolean'
    UNION ALL SELECT 'p_size', 'type_changed', 'breaking', 'string', 'integer'
    UNION ALL SELECT 'p_size', 'length_changed', 'potentially_breaking', {_SIZE_LENGTH}, NULL
    UNION ALL SELECT 'p_retailprice', 'precision_changed', 'potentially_breaking', '12', '14'
    UNION ALL SELECT 'p_retailprice', 'scale_changed', 'potentially_breaking', '2', '4'
    UNION ALL SELECT 'p_name', 'length_changed', 'potentially_breaking', {_NAME_LENGTH}, {_NEW_LENGTH}
    UNION ALL SELECT 'p_name', 'nullability_changed', 'non_breaking', 'False', 'True'
"""


def _drift(t: Tables) -> DataFrame:
    return schema.schema_drift(schema.observed_schema(t.part_after), schema.observed_schema(t.part_before))


@query("schema_drift", _DRIFT)
def schema_drift(t: Tables) -> DataFrame:
    return _drift(t)


@query(
    "schema_drift_summary",
    f"SELECT count(*) AS changes, 'breaking' AS overall_classification, true AS is_transformation_blocked FROM ({_DRIFT}) d",
)
def schema_drift_summary(t: Tables) -> DataFrame:
    return schema.drift_summary(_drift(t))


@query(
    "schema_fingerprint",
    """
    SELECT 3 AS fields, sha256('[{"len": ' || cast(max(length(s_name)) AS string) || ', "name": "s_name", "prec": null, "scale": null, "type": "string"}, '
      || '{"len": null, "name": "s_nationkey", "prec": null, "scale": null, "type": "integer"}, '
      || '{"len": null, "name": "s_suppkey", "prec": null, "scale": null, "type": "long"}]') AS schema_fingerprint FROM {supplier}
    """,
)
def schema_fingerprint(t: Tables) -> DataFrame:
    snapshot = schema.observed_schema(t.supplier.select("s_suppkey", "s_name", "s_nationkey"))
    return schema.fingerprint(snapshot)


@query(
    "lineage_record",
    """
    SELECT 'run-1' AS run_id, 'transformation' AS stage, 'orders' AS entity_id, s AS source_name, 'lake/' || s AS source_path,
           'raw' AS source_layer, 'orders-curated' AS target_name, 'lake/curated/orders' AS target_path, 'curated' AS target_layer,
           (SELECT count(*) FROM {orders}) AS record_count, '{"mapping":"v3"}' AS versions
    FROM (SELECT unnest(['orders', 'customer']) AS s) x
    """,
)
def lineage_record(t: Tables) -> DataFrame:
    return schema.lineage(
        t.orders, "run-1", "transformation", "orders",
        [("orders", "lake/orders", "raw"), ("customer", "lake/customer", "raw")],
        ("orders-curated", "lake/curated/orders", "curated"), {"mapping": "v3"},
    )


# ---------------------------------------------------------------- incremental

NOW = datetime(2001, 7, 1, 12, 0, 0)
derived(
    "watermark_state",
    """
    SELECT 'crm' AS source_id, 'conn-' || cast(o_custkey % 3 AS string) AS connection_id,
           'entity-' || cast(o_custkey % 40 AS string) AS entity_id, year(o_orderdate) - 1994 AS version,
           max(o_orderdate) AS last_watermark, 'run-' || cast(year(o_orderdate) AS string) AS run_id
    FROM {orders} WHERE o_orderdate < TIMESTAMP '2001-07-01 00:00:00' AND (o_custkey % 40 <> 7 OR year(o_orderdate) < 2000)
      AND o_custkey % 40 < 36
    GROUP BY 1, 2, 3, 4, 6
    """,
)
derived(
    "entity_configs",
    """
    SELECT DISTINCT 'crm' AS source_id, 'conn-' || cast(o_custkey % 3 AS string) AS connection_id,
           'entity-' || cast(o_custkey % 40 AS string) AS entity_id,
           CASE WHEN o_custkey % 40 IN (1, 2) THEN 'full' ELSE 'incremental' END AS load_type,
           cast(2 + o_custkey % 3 AS int) AS overlap_hours, cast(3 AS int) AS window_days,
           CASE o_custkey % 4 WHEN 0 THEN 'webhook_ingest' WHEN 3 THEN 'log_based_cdc' ELSE 'watermark_polling' END AS strategy,
           CASE WHEN o_custkey % 8 = 3 THEN 'binlog.000042:' || cast(o_custkey % 40 AS string) END AS cdc_position
    FROM {orders}
    """,
)
_MARKS = """
    SELECT source_id, connection_id, entity_id, max(version) AS version, max_by(last_watermark, version) AS last_watermark
    FROM {watermark_state} w GROUP BY 1, 2, 3
"""
_NOW = "TIMESTAMP '2001-07-01 12:00:00'"


@query(
    "extraction_windows",
    f"""
    SELECT source_id, connection_id, entity_id, load_type,
           CASE WHEN load_type = 'full' THEN {_NOW} - INTERVAL 3 DAY WHEN last_watermark IS NULL THEN TIMESTAMP '1970-01-01 00:00:00'
                ELSE last_watermark - to_hours(overlap_hours) END AS lower_bound, {_NOW} AS upper_bound
    FROM {{entity_configs}} c LEFT JOIN ({_MARKS}) m USING (source_id, connection_id, entity_id)
    """,
)
def extraction_windows(t: Tables) -> DataFrame:
    return incremental.extraction_windows(t.entity_configs, t.watermark_state, NOW)


@query(
    "sync_plans",
    f"""
    SELECT source_id, connection_id, entity_id, mode,
           CASE WHEN mode = 'webhook_drain' THEN last_watermark WHEN mode IN ('incremental_window', 'gap_backfill')
                THEN coalesce(last_watermark - to_hours(overlap_hours), {_NOW} - INTERVAL 3 DAY) END AS lower_bound,
           CASE WHEN mode NOT IN ('full', 'cdc_stream') THEN {_NOW} END AS upper_bound,
           CASE WHEN mode = 'cdc_stream' THEN cdc_position END AS cdc_position
    FROM (SELECT *, CASE strategy WHEN 'watermark_polling' THEN CASE WHEN load_type = 'full' THEN 'full' ELSE 'incremental_window' END
             WHEN 'webhook_ingest' THEN CASE WHEN last_watermark >= {_NOW} - INTERVAL 6 HOUR THEN 'webhook_drain' ELSE 'gap_backfill' END
             ELSE CASE WHEN cdc_position IS NOT NULL THEN 'cdc_stream' ELSE 'gap_backfill' END END AS mode
          FROM {{entity_configs}} c LEFT JOIN ({_MARKS}) m USING (source_id, connection_id, entity_id)) x
    """,
)
def sync_plans(t: Tables) -> DataFrame:
    return incremental.sync_plans(t.entity_configs, t.watermark_state, NOW)


_UPDATES = f"""
    SELECT source_id, connection_id, entity_id,
           CASE WHEN hashed = 0 THEN version + 1 ELSE version END AS expected_version,
           CASE WHEN hashed = 1 THEN last_watermark - INTERVAL 1 DAY ELSE last_watermark + INTERVAL 1 DAY END AS new_watermark,
           'run-new' AS run_id
    FROM (SELECT *, cast(substr(entity_id, 8) AS int) % 5 AS hashed FROM ({_MARKS}) m) x
"""
derived("watermark_updates", _UPDATES)


_ADVANCED = """
    SELECT u.source_id, u.connection_id, u.entity_id,
           CASE WHEN cast(substr(u.entity_id, 8) AS int) % 5 = 0 THEN 'version_conflict'
                WHEN cast(substr(u.entity_id, 8) AS int) % 5 = 1 THEN 'moves_backwards' ELSE 'accepted' END AS outcome,
           CASE WHEN cast(substr(u.entity_id, 8) AS int) % 5 > 1 THEN u.expected_version + 1 END AS version
    FROM {watermark_updates} u
    """


def _outcomes(accepted: DataFrame, refused: DataFrame) -> DataFrame:
    key = incremental.ENTITY_KEY
    return accepted.select(*key, F.lit("accepted").alias("outcome"), "version").unionByName(
        refused.select(*key, F.col("reason").alias("outcome"), F.lit(None).cast("long").alias("version"))
    )


@query("watermark_advance", _ADVANCED)
def watermark_advance(t: Tables) -> DataFrame:
    return _outcomes(*incremental.advance_watermarks(t.watermark_state, t.watermark_updates))


@query(
    "watermark_stored",
    f"""
    SELECT a.*, coalesce(a.version, s.version) AS stored_version FROM ({_ADVANCED}) a
    LEFT JOIN (SELECT source_id, connection_id, entity_id, max(version) AS version FROM {{watermark_state}} GROUP BY ALL) s
    USING (source_id, connection_id, entity_id)
    """,
)
def watermark_stored(t: Tables) -> DataFrame:
    """The same updates against a stored state table, and the versions stored afterwards."""
    key = incremental.ENTITY_KEY
    layer = KeyedLayer(t.spark, work_path(t.spark, "watermarks"), key)
    layer.merge(t.watermark_state, ["version"])
    judged = _outcomes(*incremental.advance_stored(layer, t.watermark_updates))
    return judged.join(layer.read().select(*key, F.col("version").alias("stored_version")), key, "left")


@query(
    "incremental_window",
    """
    SELECT o_orderkey, o_totalprice FROM {orders}
    WHERE o_orderdate >= TIMESTAMP '1999-03-01 00:00:00' AND o_orderdate < TIMESTAMP '1999-03-08 00:00:00'
    """,
)
def incremental_window(t: Tables) -> DataFrame:
    return incremental.read_window(
        t.orders, "o_orderdate", datetime(1999, 3, 1), datetime(1999, 3, 8), ["o_orderkey", "o_totalprice"]
    )


@query(
    "replay_window",
    """
    SELECT o_orderkey, o_orderstatus FROM {orders}
    WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1996-02-01 00:00:00'
    """,
)
def replay_window(t: Tables) -> DataFrame:
    lower, upper = incremental.replay_window(datetime(1996, 1, 1), datetime(1996, 2, 1))
    return incremental.read_window(t.orders, "o_orderdate", lower, upper, ["o_orderkey", "o_orderstatus"])


@query(
    "overlap_merge",
    "SELECT o_orderkey, o_totalprice, o_orderstatus FROM {orders} WHERE o_orderdate < TIMESTAMP '1999-06-01 00:00:00'",
)
def overlap_merge(t: Tables) -> DataFrame:
    columns = ["o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate"]
    first = incremental.read_window(t.orders, "o_orderdate", None, datetime(1999, 3, 1), columns)
    again = incremental.read_window(t.orders, "o_orderdate", datetime(1999, 1, 1), datetime(1999, 6, 1), columns)
    return merge.merge_current(first, again, ["o_orderkey"], ["o_orderdate"]).drop("o_orderdate")


_JOBS = """
    SELECT o_orderstatus AS job, cast(min(o_orderdate) AS date) AS window_start, cast(max(o_orderdate) AS date) AS window_end,
           cast(count(*) AS double) * 1000 / (date_diff('day', cast(min(o_orderdate) AS date), cast(max(o_orderdate) AS date)) + 1) AS per_day
    FROM {orders} o GROUP BY 1
"""
_SIZED = f"SELECT *, cast(greatest(1, least(90, floor(500.0 * 600 / per_day))) AS int) AS chunk_days FROM ({_JOBS}) j"


@query(
    "backfill_chunks",
    f"""
    SELECT c.job, c.sequence, c.chunk_days, c.chunk_start, c.chunk_end, coalesce(n, 0) AS rows FROM (
      SELECT job, chunk_days, sequence, (window_start + cast(sequence * chunk_days AS integer)) AS chunk_start,
             least(window_start + cast(sequence * chunk_days + chunk_days - 1 AS integer), window_end) AS chunk_end
      FROM (SELECT *, unnest(range(0, cast(ceil((window_end - window_start + 1) / chunk_days) AS bigint))) AS sequence FROM ({_SIZED}) s) q) c
    LEFT JOIN (SELECT job, (cast(o_orderdate AS date) - window_start) // chunk_days AS sequence, count(*) AS n
               FROM {{orders}} o JOIN ({_SIZED}) s ON o.o_orderstatus = s.job GROUP BY ALL) r
    ON c.job = r.job AND c.sequence = r.sequence
    """,
)
def backfill_chunks(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    windows = t.orders.groupBy(F.col("o_orderstatus").alias("job")).agg(
        F.min(day).alias("window_start"), F.max(day).alias("window_end"), F.count(F.lit(1)).alias("n")
    )
    per_day = F.col("n").cast("double") * 1000 / (F.date_diff("window_end", "window_start") + 1)
    sized = windows.withColumn(
        "chunk_days", incremental.chunk_days(F.lit(incremental.ROWS_PER_SECOND), per_day)
    ).drop("n")
    # The job is every chunk: at many orders a day a chunk is one day, and the window has more days
    # than the planner takes by itself.
    chunks = incremental.plan_chunks(sized, max_chunks=None)
    rows = (
        t.orders.select(F.col("o_orderstatus").alias("job"), day.alias("day"))
        .join(sized, "job")
        .groupBy(
            "job",
            incremental.chunk_of(F.col("day"), F.col("window_start"), F.col("chunk_days")).alias("sequence"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return chunks.join(rows, ["job", "sequence"], "left").select(
        "job", "sequence", "chunk_days", "chunk_start", "chunk_end", F.coalesce("n", F.lit(0)).alias("rows")
    )


derived(
    "chunk_events",
    """
    SELECT 'job-' || cast(user_id % 5 AS string) AS job_id, cast(user_id % 17 AS int) AS sequence,
           CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'compensated'
                ELSE 'running' END AS event, cast(event_id AS bigint) AS rows, ts AS happened_at
    FROM {events} WHERE event_type <> 'signup' OR user_id % 3 = 0
    """,
)
_LEDGER = """
    SELECT e.job_id, e.sequence, CASE WHEN min(CASE WHEN event = 'completed' AND (reset IS NULL OR happened_at > reset) THEN happened_at END) IS NOT NULL
             THEN 'completed' ELSE max_by(event, happened_at) END AS state,
           coalesce(min_by(rows, CASE WHEN event = 'completed' AND (reset IS NULL OR happened_at > reset) THEN happened_at END), 0) AS rows_processed,
           count_if(event = 'running') AS attempts
    FROM {chunk_events} e JOIN (SELECT job_id, sequence, max(CASE WHEN event = 'compensated' THEN happened_at END) AS reset
                                FROM {chunk_events} c GROUP BY 1, 2) r ON e.job_id = r.job_id AND e.sequence = r.sequence
    GROUP BY 1, 2
"""


@query("backfill_ledger", _LEDGER, bigint=("attempts",))
def backfill_ledger(t: Tables) -> DataFrame:
    return incremental.chunk_ledger(t.chunk_events, ["job_id"])


@query(
    "backfill_resume",
    f"SELECT job_id, min(CASE WHEN state <> 'completed' THEN sequence END) AS next_sequence FROM ({_LEDGER}) l GROUP BY 1",
)
def backfill_resume(t: Tables) -> DataFrame:
    return incremental.resume_pointer(incremental.chunk_ledger(t.chunk_events, ["job_id"]), ["job_id"])


@query("capped_read", "SELECT event_id, event_type FROM {events} ORDER BY ts, event_id LIMIT 777")
def capped_read(t: Tables) -> DataFrame:
    rows, _ = incremental.capped_read(t.events, "ts", 777, ["event_id"])
    return rows.select("event_id", "event_type")


@query(
    "capped_read_checkpoint",
    "SELECT count(*) AS rows, max(ts) AS resume_from FROM (SELECT ts FROM {events} ORDER BY ts, event_id LIMIT 777) x",
)
def capped_read_checkpoint(t: Tables) -> DataFrame:
    rows, _ = incremental.capped_read(t.events, "ts", 777, ["event_id"])
    return incremental.checkpoint_watermark(rows, "ts")


# ---------------------------------------------------------------- storage layers


@query(
    "raw_layer",
    """
    SELECT '1999-01-01' AS extraction_date, 'run-1' AS run_id, c_mktsegment, count(*) AS rows,
           cast(sum(cast(c_acctbal AS decimal(18,2))) AS double) AS balance FROM {customer} GROUP BY ALL
    """,
)
def raw_layer(t: Tables) -> DataFrame:
    path = work_path(t.spark, "raw")
    sinks.write_raw(t.customer, path, "1999-01-01", "run-1")
    raw = layers.read_layer(t.spark, path, merge_schema=True)
    return raw.groupBy(F.col("extraction_date").cast("string").alias("extraction_date"), "run_id", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"),
    )


@query("curated_latest", "SELECT s_suppkey, s_name, 'run-b' AS run_id FROM {supplier} WHERE s_suppkey % 2 = 0")
def curated_latest(t: Tables) -> DataFrame:
    path = work_path(t.spark, "curated")
    rows = t.supplier.select("s_suppkey", "s_name")
    sinks.write_curated(rows, path, date(2024, 1, 1), "run-z")
    sinks.write_curated(rows, path, date(2024, 1, 2), "run-a")
    sinks.write_curated(rows.where("s_suppkey % 2 = 0"), path, date(2024, 1, 2), "run-b")
    return layers.latest_curated(t.spark, path).select("s_suppkey", "s_name", "run_id")


@query(
    "analytics_publish",
    """
    SELECT CASE WHEN c_custkey % 2 = 0 THEN '2024-02-01' ELSE '2024-02-02' END AS analytics_date, count(*) AS rows
    FROM {customer} GROUP BY 1
    """,
)
def analytics_publish(t: Tables) -> DataFrame:
    path = work_path(t.spark, "analytics")
    golden = t.golden_company.withColumn("match_run_id", F.lit("r")).withColumn("_source_id", F.lit("s"))
    even, odd = golden.where("customer_key % 2 = 0"), golden.where("customer_key % 2 = 1")
    sinks.publish_analytics(golden, path, date(2024, 2, 1))
    sinks.publish_analytics(even, path, date(2024, 2, 1))
    sinks.publish_analytics(odd, path, date(2024, 2, 2))
    stored = layers.read_layer(t.spark, path)
    if set(sinks.INTERNAL_COLUMNS) & set(stored.columns):
        raise ValueError("internal columns were published")
    return stored.groupBy(F.col("analytics_date").cast("string").alias("analytics_date")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query(
    "analytics_rows",
    """
    SELECT golden_id, customer_key, stage, scope_unit_id,
           CASE WHEN customer_key % 2 = 0 THEN '2024-02-01' ELSE '2024-02-02' END AS analytics_date
    FROM {golden_company}
    """,
)
def analytics_rows(t: Tables) -> DataFrame:
    """The stored rows of two days, the first published twice."""
    path = work_path(t.spark, "analytics")
    golden = t.golden_company.withColumn("match_run_id", F.lit("r")).withColumn("_record_id", F.lit("x"))
    for days, rest in ((1, None), (1, 0), (2, 1)):
        rows = golden if rest is None else golden.where(F.col("customer_key") % 2 == rest)
        sinks.publish_analytics(rows, path, date(2024, 2, days))
    stored = layers.read_layer(t.spark, path)
    if set(sinks.INTERNAL_COLUMNS) & set(stored.columns):
        raise ValueError("internal columns were published")
    day = F.col("analytics_date").cast("string").alias("analytics_date")
    return stored.select("golden_id", "customer_key", "stage", "scope_unit_id", day)


@query("analytics_latest", "SELECT golden_id FROM {golden_company} WHERE customer_key % 2 = 1")
def analytics_latest(t: Tables) -> DataFrame:
    path = work_path(t.spark, "analytics")
    sinks.publish_analytics(t.golden_company, path, date(2024, 2, 1))
    sinks.publish_analytics(t.golden_company.where("customer_key % 2 = 1"), path, date(2024, 2, 2))
    return layers.latest_analytics(t.spark, path).select("golden_id")


@query(
    "golden_publish",
    """
    SELECT 'golden' AS part, count(DISTINCT email) AS rows FROM {people} p WHERE email IS NOT NULL
    UNION ALL SELECT 'membership', 2 * count(*) FROM {people} q
    UNION ALL SELECT 'decisions', count(*) FROM {people} r
    """,
)
def golden_publish(t: Tables) -> DataFrame:
    path = work_path(t.spark, "golden")
    people = t.people.select(F.col("c_custkey").alias("pk"), F.col("email").alias("email_address"), "full_name", "scope_unit_id")
    records = matching.union_sources({"crm": people, "erp": people}, "pk")
    rules = matching.MatchRules("person", "v1", (matching.ExactRule("email", (matching.ExactField("email_address"),)),))
    done = jobs.resolve_entities(records, rules, survivorship.Survivorship("person", "v1"), "run-1")
    sinks.publish_golden(done.golden, done.links, done.membership, path, date(2024, 1, 1), "run-1")
    parts = [
        layers.read_layer(t.spark, f"{path}/{p}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(p).alias("part"), "rows")
        for p in ("golden", "membership", "decisions")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "golden_rows",
    """
    SELECT 'gid-' || substr(sha256('_source_id:person:crm:' || cast(c_custkey AS string) || '|erp:' || cast(c_custkey AS string)), 1, 16) AS golden_id,
           email AS email_address, full_name, scope_unit_id, 2 AS contributing_record_count, 'run-1' AS run_id,
           'crm:' || cast(c_custkey AS string) || '|erp:' || cast(c_custkey AS string) AS members,
           'crm:' || cast(c_custkey AS string) AS record_a_id, 'erp:' || cast(c_custkey AS string) AS record_b_id
    FROM {people} p
    """,
    bigint=("contributing_record_count",),
)
def golden_rows(t: Tables) -> DataFrame:
    """Published golden rows with their members, and the decision that made each."""
    path = work_path(t.spark, "golden")
    people = t.people.select(F.col("c_custkey").alias("pk"), F.col("email").alias("email_address"), "full_name", "scope_unit_id")
    records = matching.union_sources({"crm": people, "erp": people}, "pk")
    rules = matching.MatchRules("person", "v1", (matching.ExactRule("email", (matching.ExactField("email_address"),)),))
    done = jobs.resolve_entities(records, rules, survivorship.Survivorship("person", "v1"), "run-1")
    sinks.publish_golden(done.golden, done.links, done.membership, path, date(2024, 1, 1), "run-1")
    golden = layers.read_layer(t.spark, f"{path}/golden")
    membership = layers.read_layer(t.spark, f"{path}/membership")
    bucketed.publish_members(golden, membership, path, "run-1", 16)
    links = layers.read_layer(t.spark, f"{path}/decisions").select("record_a_id", "record_b_id")
    listed = bucketed.golden_with_members(t.spark, path, "run-1")
    first = F.col(bucketed.MEMBERS)[0]
    return listed.join(links, first == F.col("record_a_id")).select(
        "golden_id", "email_address", "full_name", "scope_unit_id", "contributing_record_count", "run_id",
        F.array_join(bucketed.MEMBERS, "|").alias("members"), "record_a_id", "record_b_id",
    )


_EXPORTED = """
    SELECT golden_id, stage, scope_unit_id FROM {golden_company} WHERE scope_unit_id IN ('unit-3', 'unit-4', 'unit-5')
"""


def _exported(t: Tables, fmt: str) -> tuple[str, int]:
    path = work_path(t.spark, f"export-{fmt}")
    rows = t.golden_company.select("golden_id", "stage", "scope_unit_id")
    return path, sinks.export(rows, path, fmt, _SOME_UNITS)


_EXPORT_SCHEMA = "golden_id string, stage string, scope_unit_id string"


@query("export_scoped_csv", _EXPORTED)
def export_scoped_csv(t: Tables) -> DataFrame:
    path, rows = _exported(t, "csv")
    return layers.read_bulk_csv(t.spark, path, _EXPORT_SCHEMA, rows)


@query("export_scoped_json", _EXPORTED)
def export_scoped_json(t: Tables) -> DataFrame:
    return t.spark.read.schema(_EXPORT_SCHEMA).json(_exported(t, "json")[0])


@query("export_scoped_parquet", _EXPORTED)
def export_scoped_parquet(t: Tables) -> DataFrame:
    return layers.read_layer(t.spark, _exported(t, "parquet")[0])


@query("nested_json_ingest", "SELECT o_orderkey AS id, o_totalprice AS amount FROM {orders}")
def nested_json_ingest(t: Tables) -> DataFrame:
    path = work_path(t.spark, "landed")
    record = F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    empty = F.lit(None).cast("struct<id:bigint,amount:double>")
    items = F.array(F.struct(record.alias("order")), F.struct(empty.alias("order")))
    t.orders.select(F.struct(items.alias("items")).alias("data")).write.json(path)
    declared = "data struct<items:array<struct<order:struct<id:bigint,amount:double>>>>"
    return layers.read_nested_json(t.spark, path, "data.items", declared, unwrap="order")


@query(
    "sql_over_views",
    "SELECT o_orderpriority, count(*) AS orders FROM {orders} WHERE o_totalprice >= 250000 AND o_orderstatus = 'F' GROUP BY 1",
)
def sql_over_views(t: Tables) -> DataFrame:
    return layers.run_sql(
        t.spark,
        "SELECT o_orderpriority, count(*) AS orders FROM stored_orders WHERE o_totalprice >= ? AND o_orderstatus = ? GROUP BY 1",
        {"stored_orders": t.path("orders")},
        [250000, "F"],
    )


@query("query_to_parquet", "SELECT l_returnflag, count(*) AS lines, (SELECT count(DISTINCT l_returnflag) FROM {lineitem}) AS written FROM {lineitem} GROUP BY 1")
def query_to_parquet(t: Tables) -> DataFrame:
    path = work_path(t.spark, "ctas")
    result = t.lineitem.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"))
    written = sinks.materialise(result, path)
    return layers.read_layer(t.spark, path).withColumn("written", F.lit(written).cast("long"))


@query("field_selection", "SELECT s_suppkey, s_nationkey FROM {supplier}")
def field_selection(t: Tables) -> DataFrame:
    return layers.select_fields(t.supplier, "standard", exclude=("s_name",), custom=("s_acctbal",))


@query(
    "serving_load",
    """
    SELECT p_partkey, p_name, p_size, p_brand FROM {part_target} t WHERE p_partkey % 3 = 0
    UNION ALL SELECT p_partkey, p_name, p_size, p_brand FROM {part} p WHERE p_partkey % 3 <> 0
    """,
)
def serving_load(t: Tables) -> DataFrame:
    columns = ["p_partkey", "p_name", "p_size", "p_brand"]
    path, keys = work_path(t.spark, "serving"), ["p_partkey"]
    sinks.load_serving(t.spark, path, t.part_target, keys, columns, bucket_bytes=256 << 10)
    incoming = t.part.where("p_partkey % 3 <> 0")
    sinks.load_serving(t.spark, path, incoming, keys, columns, bucket_bytes=256 << 10)
    return sinks.read_serving(t.spark, path, keys).select(*columns)


# ---------------------------------------------------------------- lifecycle

derived(
    "run_audit",
    """
    SELECT CASE WHEN user_id % 3 = 0 THEN 'tenant-a' WHEN user_id % 3 = 1 THEN 'tenant-b' ELSE 'tenant-c' END AS tenant_code,
           'run-' || cast(user_id AS string) || '-' || cast(cast(ts AS date) AS string) AS run_id,
           'entity-' || cast(user_id % 5 AS string) AS entity_id,
           CASE WHEN event_type IN ('view', 'click', 'signup') THEN 'extraction' ELSE 'transformation' END AS stage,
           CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'started' WHEN 'click' THEN
             CASE WHEN event_id % 9 = 0 THEN 'Failed' ELSE 'success' END ELSE 'success' END AS status,
           cast(floor(value) AS bigint) AS record_count, ts AS started_at, ts + INTERVAL '5' MINUTE AS completed_at
    FROM {events}
    """,
)


@query(
    "usage_metering",
    """
    SELECT tenant_code, strftime(started_at, '%Y-%m') AS period, entity_id,
           cast(coalesce(sum(CASE WHEN status = 'success' THEN record_count END), 0) AS bigint) AS records_processed,
           count_if(status = 'success') AS runs_completed, count_if(lower(status) = 'failed') AS runs_failed
    FROM {run_audit} WHERE stage = 'extraction' GROUP BY ALL
    """,
    bigint=("runs_completed", "runs_failed"),
)
def usage_metering(t: Tables) -> DataFrame:
    return lifecycle.usage(t.run_audit)


@query(
    "run_status",
    """
    SELECT tenant_code, run_id, CASE WHEN count_if(lower(status) = 'failed') > 0 THEN 'failed'
             WHEN count_if(lower(status) <> 'success') = 0 THEN 'success' ELSE 'in_progress' END AS status,
           max_by(stage, completed_at) AS latest_stage, min(started_at) AS started_at, max(completed_at) AS completed_at,
           count(*) AS stages FROM {run_audit} GROUP BY 1, 2
    """,
)
def run_status(t: Tables) -> DataFrame:
    return lifecycle.run_summary(t.run_audit)


@query(
    "tenant_erase",
    """
    SELECT 'audit' AS store, 'deleted' AS outcome, count_if(tenant_code = 'tenant-b') AS rows_deleted, '' AS retention_basis,
           0 AS remaining_rows, true AS verified, true AS complete FROM {run_audit} a
    UNION ALL
    SELECT 'invoices', 'retained_under_hold', 0, 'case 17', count_if(tenant_code = 'tenant-b'), true, true FROM {run_audit} b WHERE stage = 'extraction'
    """,
    bigint=("rows_deleted", "remaining_rows"),
)
def tenant_erase(t: Tables) -> DataFrame:
    stores = {"audit": t.run_audit, "invoices": t.run_audit.where("stage = 'extraction'")}
    kept, report = lifecycle.erase_tenant(stores, "tenant-b", {"invoices": "case 17"}, ("invoices",))
    path = work_path(t.spark, "erased")
    sinks.materialise(kept["audit"], path)
    now = {"audit": layers.read_layer(t.spark, path), "invoices": kept["invoices"]}
    return lifecycle.erasure_certificate(report, now, "tenant-b")


# ---------------------------------------------------------------- whole jobs

_TRANSFORM_RULES = (
    mapping.MappingRule(("id",), "order_id", on_missing="raise_error"),
    mapping.MappingRule(("amount",), "amount", "cast", {"type": "decimal"}),
    mapping.MappingRule(("status",), "status"),
    mapping.MappingRule(("customer",), "email_ref", "cast", {"type": "string"}),
    mapping.MappingRule(("revision",), "revision", "cast", {"type": "integer"}),
    mapping.MappingRule(("is_delete",), "removed", "cast", {"type": "boolean"}),
    mapping.MappingRule(("owner",), "owner"),
)
derived("order_delta_raw", "SELECT *, 'UNIT-' || cast(customer % 25 AS string) AS owner FROM {order_delta} d")
derived(
    "order_state_curated",
    """
    SELECT id AS order_id, amount, status, cast(customer AS string) AS email_ref, cast(revision AS bigint) AS revision,
           false AS removed, 'x' AS owner, cast(NULL AS string) AS scope_unit_id FROM {order_state} s
    """,
)


def _spec(t: Tables, mode: str = "warn", severity: str = "warning") -> jobs.TransformSpec:
    return jobs.TransformSpec(
        _TRANSFORM_RULES,
        ("order_id",),
        ("revision",),
        scope.Attribution(field="owner"),
        (quality.AllowedCheck("status", frozenset({"O", "F", "P"}), severity),),
        quality.BatchPolicy(required=("order_id", "amount"), natural_key=("order_id",), mode=mode),
        soft_delete="removed",
    )


_LATEST_RAW = """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY revision DESC) AS rn
                   FROM {order_delta_raw} d WHERE id <> '') r WHERE rn = 1
"""
_MASKED = """CASE WHEN length({0}) <= 4 THEN repeat('*', length({0}))
                  ELSE repeat('*', length({0}) - 4) || right({0}, 4) END"""


_TRANSFORMED = f"""
    SELECT order_id, amount, status, email_ref, revision, removed, owner, scope_unit_id FROM {{order_state_curated}} p
    WHERE order_id NOT IN (SELECT id FROM ({_LATEST_RAW}) l1)
    UNION ALL
    SELECT id, amount, status, {_MASKED.format('cast(customer AS string)')}, revision, false, owner, lower(owner)
    FROM ({_LATEST_RAW}) l2 WHERE is_delete <> 'Yes' AND lower(owner) IN (SELECT scope_unit_id FROM {{units}} u)
    UNION ALL
    SELECT id, amount, status, {_MASKED.format('cast(customer AS string)')}, revision, false, owner, NULL
    FROM ({_LATEST_RAW}) l3 WHERE is_delete <> 'Yes' AND lower(owner) NOT IN (SELECT scope_unit_id FROM {{units}} u)
"""


@query("transform_job", _TRANSFORMED)
def transform_job(t: Tables) -> DataFrame:
    return jobs.transform(t.order_delta_raw, _spec(t), t.order_state_curated, t.units).curated


@query("transform_layered", _TRANSFORMED)
def transform_layered(t: Tables) -> DataFrame:
    """The same delta, merged into a layer that already holds the state."""
    layer = KeyedLayer(t.spark, work_path(t.spark, "layer"), ["order_id"], bucket_bytes=512 << 10)
    layer.merge(t.order_state_curated, ["revision"])
    done, _ = jobs.transform_into(layer, t.order_delta_raw, _spec(t), t.units)
    return done.curated.select(*t.order_state_curated.columns)


@query("transform_rejects", "SELECT customer, revision, 'order_id' AS reject_reason FROM {order_delta_raw} WHERE id IS NULL OR id = ''")
def transform_rejects(t: Tables) -> DataFrame:
    rejected = jobs.transform(t.order_delta_raw, _spec(t), None, t.units).rejected
    return rejected.select("customer", "revision", "reject_reason")


@query(
    "transform_blocked",
    """
    SELECT true AS blocked, count(*) AS violations FROM {order_delta_raw} WHERE id <> '' AND status = 'U'
    """,
)
def transform_blocked(t: Tables) -> DataFrame:
    result = jobs.transform(t.order_delta_raw, _spec(t, "block", "blocking"), None, t.units)
    return result.violations.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(result.blocked and result.curated is None).alias("blocked"), "violations"
    )


@query(
    "reprocess_window",
    """
    SELECT year(d) AS year, sum(CASE WHEN d >= DATE '1997-03-01' AND d <= DATE '1997-08-31' THEN 2 ELSE 1 END * n) AS weight
    FROM (SELECT cast(o_orderdate AS date) AS d, count(*) AS n FROM {orders} GROUP BY 1) x
    WHERE d IS NOT NULL GROUP BY 1
    """,
    bigint=("weight",),
)
def reprocess_window(t: Tables) -> DataFrame:
    path = work_path(t.spark, "layer")
    source = t.orders.select(F.col("o_orderdate").cast("date").alias("day"), "o_orderkey")

    def build(weight: int):
        return lambda df: df.groupBy("day").agg((F.count(F.lit(1)) * weight).alias("weight"))

    jobs.reprocess(source, "day", date(1900, 1, 1), date(2999, 12, 31), build(1), path)
    jobs.reprocess(source, "day", date(1997, 3, 1), date(1997, 8, 31), build(2), path)
    stored = layers.read_layer(t.spark, path)
    return stored.groupBy(F.year("day").alias("year")).agg(F.sum("weight").alias("weight"))
