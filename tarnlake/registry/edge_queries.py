"""Queries whose inputs go past the sizes, nulls and orders of the other queries' inputs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarnlake.functions.fiscal import RELATIVE_RANGES
from tarnlake.operators import clusters, graph, incremental, mapping, scope, survivorship
from tarnlake.operators.scope import unrestricted
from tarnlake.plans import metrics
from tarnlake.plans.model import Dimension, Entity, Metric, MetricModel, MetricRequest, TimeDimension, TimeRange
from tarnlake.registry.base import Tables, derived, query
from tarnlake.registry.entity_queries import POLICY
from tarnlake.registry.record_queries import _MERGED
from tarnlake.session import cut_lineage, work_path
from tarnlake.sources import layers, sinks
from tarnlake.sources.keyed_layer import KeyedLayer
from tarnlake.streaming import events

TODAY = date(1999, 8, 15)
ANYONE = unrestricted("definition_validation")
_LINES = MetricModel(
    (
        Entity(
            "line",
            (Dimension("order_id", "l_orderkey"), Dimension("line_no", "l_linenumber")),
            (Metric("quantity", "sum", "l_quantity", scale=2), Metric("rows", "count")),
            (TimeDimension("shipped", "l_shipdate"),),
        ),
    )
)


@query(
    "semantic_every_group",
    """
    SELECT l_orderkey AS order_id, l_linenumber AS line_no,
           cast(sum(cast(l_quantity AS decimal(18,2))) AS double) AS quantity FROM {lineitem} GROUP BY 1, 2
    """,
)
def semantic_every_group(t: Tables) -> DataFrame:
    """A group for each line: far above the former default row limit."""
    request = MetricRequest("line", ("quantity",), ("order_id", "line_no"))
    return metrics.metric_query(_LINES, request, {"line": t.lineitem}, scope=ANYONE)


@query(
    "semantic_row_limit",
    """
    SELECT order_id, line_no, quantity, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM {lineitem}) d) - 250 AS rows_cut
    FROM (SELECT l_orderkey AS order_id, l_linenumber AS line_no,
                 cast(sum(cast(l_quantity AS decimal(18,2))) AS double) AS quantity FROM {lineitem} GROUP BY 1, 2
          ORDER BY 1, 2 LIMIT 250) x
    """,
)
def semantic_row_limit(t: Tables) -> DataFrame:
    """A limit that is asked for: ordered, and with the number of groups it leaves out."""
    names = ("order_id", "line_no")
    limited = MetricRequest("line", ("quantity",), names, row_limit=250)
    whole = metrics.metric_query(_LINES, MetricRequest("line", ("quantity",), names), {"line": t.lineitem}, scope=ANYONE)
    cut = metrics.rows_cut(whole, limited).select("rows_cut")
    first = metrics.metric_query(_LINES, limited, {"line": t.lineitem}, scope=ANYONE)
    return first.join(cut, how="full_outer")


_RANGES = {
    "today": ("1999-08-15", "1999-08-16"),
    "yesterday": ("1999-08-14", "1999-08-15"),
    "last_7_days": ("1999-08-09", "1999-08-16"),
    "last_30_days": ("1999-07-17", "1999-08-16"),
    "last_90_days": ("1999-05-18", "1999-08-16"),
    "month_to_date": ("1999-08-01", "1999-08-16"),
    "quarter_to_date": ("1999-07-01", "1999-08-16"),
    "year_to_date": ("1999-01-01", "1999-08-16"),
    "last_month": ("1999-07-01", "1999-08-01"),
    "last_quarter": ("1999-04-01", "1999-07-01"),
    "last_year": ("1998-01-01", "1999-01-01"),
}


@query(
    "semantic_relative_ranges",
    " UNION ALL ".join(
        f"SELECT '{name}' AS range_name, count(*) AS rows FROM {{lineitem}} r{i}"
        f" WHERE l_shipdate >= TIMESTAMP '{a} 00:00:00' AND l_shipdate < TIMESTAMP '{b} 00:00:00'"
        for i, (name, (a, b)) in enumerate(_RANGES.items())
    ),
)
def semantic_relative_ranges(t: Tables) -> DataFrame:
    """All named ranges, each as its own request."""
    parts = None
    for name in RELATIVE_RANGES:
        request = MetricRequest("line", ("rows",), time="shipped", grain="year", time_range=TimeRange(name))
        rows = metrics.metric_query(_LINES, request, {"line": t.lineitem}, scope=ANYONE, today=TODAY)
        total = rows.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
        named = total.select(F.lit(name).alias("range_name"), "rows")
        parts = named if parts is None else parts.unionByName(named)
    return parts


# ---------------------------------------------------------------- clusters, hubs, hierarchies

derived(
    "line_membership",
    """
    SELECT 'c' || cast(l_orderkey % 3 AS string) AS cluster,
           'l:' || cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) AS _record_id
    FROM {lineitem}
    """,
)


@query(
    "er_golden_ids_large",
    """
    SELECT cluster, 'gid-' || substr(sha256('_source_id:line:' || string_agg(_record_id, '|' ORDER BY _record_id)), 1, 16)
           AS golden_id, count(*) AS member_count FROM {line_membership} GROUP BY cluster
    """,
)
def er_golden_ids_large(t: Tables) -> DataFrame:
    """Clusters that each hold a third of all lines: the same id formula as for small ones."""
    return clusters.golden_ids(t.line_membership, "line")


derived("hubs", "SELECT 'hub-' || cast(r_regionkey AS string) AS golden_id, r_regionkey AS k FROM {region}")
derived(
    "spokes",
    """
    SELECT 'line-' || cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) AS golden_id,
           l_orderkey % 2 AS k FROM {lineitem}
    """,
)


@query(
    "twin_hub_edges",
    """
    SELECT 'hub-1' AS from_golden_id, golden_id AS to_golden_id, count(*) OVER () AS edge_count
    FROM {spokes} WHERE k = 1
    """,
)
def twin_hub_edges(t: Tables) -> DataFrame:
    """A node with half of all lines as neighbours keeps every edge."""
    rule = graph.Relationship("shipped", "region", "line", "k", "k")
    edges = graph.edges(rule, t.hubs, t.spokes)
    twins = graph.build_twins(t.hubs, edges, "region")
    path = work_path(t.spark, "twins")
    sinks.publish_twins(twins, edges, path, "run-1")
    twins, edges = layers.read_twins(t.spark, path, "run-1")
    found = graph.find_twin(twins, "region", "hub-1", ANYONE).select("golden_id", "edge_count")
    own = graph.twin_edges(edges, "hub-1")
    return found.join(own, F.col("golden_id") == F.col("from_golden_id")).select(
        "from_golden_id", "to_golden_id", "edge_count"
    )


derived(
    "deep_units",
    """
    SELECT 'n' || cast(k AS string) AS scope_unit_id, 'n' || cast(k - 1 AS string) AS parent_scope_unit_id FROM
      (SELECT DISTINCT n_nationkey * 3 + r_regionkey % 3 AS k FROM {nation}, {region}) a
    UNION ALL
    SELECT 'n' || cast(k AS string), 'n' || cast(k - 2 AS string) FROM
      (SELECT DISTINCT n_nationkey * 3 + r_regionkey % 3 AS k FROM {nation}, {region}) b WHERE k % 10 = 9
    UNION ALL
    SELECT 'n4', 'n' || cast(max(n_nationkey) * 3 + 2 AS string) FROM {nation} c
    """,
)


@query(
    "scope_deep_tree",
    """
    WITH RECURSIVE reach AS (
      SELECT 'n2' AS scope_unit_id
      UNION SELECT u.scope_unit_id FROM {deep_units} u JOIN reach r ON u.parent_scope_unit_id = r.scope_unit_id)
    SELECT scope_unit_id FROM reach
    """,
)
def scope_deep_tree(t: Tables) -> DataFrame:
    """A chain of more than 64 levels with diamonds and a cycle at its end."""
    grants = t.deep_units.where("scope_unit_id = 'n2'")
    reached = scope.granted_filter(grants, cut_lineage(t.deep_units))
    return reached.table


# ---------------------------------------------------------------- reads and streams

derived(
    "marked_events",
    "SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN ts END AS ts FROM {events}",
)


@query(
    "capped_read_nulls",
    """
    SELECT event_id, false AS unmarked FROM {marked_events} a WHERE ts IS NOT NULL
    UNION ALL
    SELECT event_id, true FROM (SELECT event_id FROM {marked_events} b WHERE ts IS NULL ORDER BY event_id LIMIT 7) x
    """,
)
def capped_read_nulls(t: Tables) -> DataFrame:
    """A limit that falls among the rows without a watermark."""
    marked = t.marked_events.agg(F.count("ts")).first()[0]
    rows, _ = incremental.capped_read(t.marked_events, "ts", marked + 7, ["event_id"])
    return rows.select("event_id", F.col("ts").isNull().alias("unmarked"))


@query(
    "capped_read_mixed",
    "SELECT event_id FROM {marked_events} WHERE ts IS NOT NULL ORDER BY ts, event_id LIMIT 333",
)
def capped_read_mixed(t: Tables) -> DataFrame:
    """A limit among the marked rows of a table that also has unmarked ones."""
    return incremental.capped_read(t.marked_events, "ts", 333, ["event_id"])[0].select("event_id")


@query("stream_late_first", "SELECT count(*) AS events, sum(event_id) AS ids FROM {events}")
def stream_late_first(t: Tables) -> DataFrame:
    """Five deliveries, each with repeats of the one before and first events ten days late."""
    source, inbox = work_path(t.spark, "deliveries"), work_path(t.spark, "inbox")
    number = F.col("event_id")
    late = F.when(number % 7 == 0, F.col("ts") - F.expr("INTERVAL 10 DAYS")).otherwise(F.col("ts"))
    sent = t.events.select(
        F.lit("t").alias("tenant_code"),
        F.lit("c").alias("connection_id"),
        F.lit("shop").alias("source_id"),
        F.concat(F.lit('{"id":"'), number.cast("string"), F.lit('"}')).alias("body"),
        late.cast("timestamp").alias("ts"),
        number.alias("number"),
        (number % 5).cast("int").alias("delivery"),
    )
    again = sent.where("number % 3 = 0").withColumn("delivery", F.col("delivery") + 1)
    whole = cut_lineage(sent.unionByName(again))
    for delivery in range(6):
        part = whole.where(F.col("delivery") == delivery).drop("delivery")
        part.coalesce(1).write.mode("append").parquet(source)
    schema = whole.drop("delivery").schema
    stream = events.read_files(t.spark, source, schema, files_per_trigger=1)
    unique = events.dedupe(events.received(events.identify(stream)))
    events.append_available(unique, inbox, work_path(t.spark, "checkpoint"))
    return t.spark.read.parquet(inbox).agg(
        F.count(F.lit(1)).alias("events"), F.sum("number").cast("decimal(38,0)").alias("ids")
    )


# ---------------------------------------------------------------- layers, mapping, JSON


@query(
    "raw_chunked",
    "SELECT count(*) AS rows, sum(l_orderkey) AS keys, true AS bounded, true AS in_order FROM {lineitem}",
)
def raw_chunked(t: Tables) -> DataFrame:
    """Raw files of at most 700 rows that follow each other in the order of the key."""
    path = work_path(t.spark, "raw")
    sinks.write_raw(t.lineitem.select("l_orderkey", "l_partkey"), path, "2024-01-01", "run-1", 700, "l_orderkey")
    key = F.col("l_orderkey").cast("long")
    files = (
        t.spark.read.parquet(path)
        .groupBy(F.input_file_name().alias("file"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"), F.sum(key).alias("s"))
    )
    after = files.withColumn("next", F.lead("lo").over(Window.orderBy("lo", "hi")))
    return after.agg(
        F.sum("n").alias("rows"),
        F.sum("s").cast("decimal(38,0)").alias("keys"),
        (F.max("n") <= 700).alias("bounded"),
        F.coalesce(F.bool_and(F.col("hi") <= F.col("next")), F.lit(True)).alias("in_order"),
    )


@query("identity_mapping", "SELECT *, (SELECT count(*) FROM {nation} x) * 0 AS rejected FROM {nation}")
def identity_mapping(t: Tables) -> DataFrame:
    """No rule set: rows pass through and nothing is rejected."""
    mapped, rejected = mapping.map_fields(t.nation, None)
    return mapped.join(rejected.agg(F.count(F.lit(1)).alias("rejected")), how="full_outer")


@query(
    "golden_lists_json",
    "SELECT n_regionkey, cast(to_json(list(n_name ORDER BY n_name)) AS VARCHAR) AS names FROM {nation} GROUP BY 1",
)
def golden_lists_json(t: Tables) -> DataFrame:
    lists = t.nation.groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("names"))
    return survivorship.flatten_lists(lists)


derived(
    "nation_people",
    """
    SELECT 'c' || cast(n_regionkey AS string) AS cluster, 'crm:' || cast(n_nationkey AS string) AS _record_id,
           'crm' AS _source_id, n_name AS full_name, CASE WHEN n_nationkey % 2 = 0 THEN n_name || '@x' END AS email_address,
           '2024-01-0' || cast(n_regionkey + 1 AS string) AS last_modified, cast(NULL AS string) AS phone,
           cast(n_nationkey AS double) AS balance, 'seg' AS segment, 'unit-1' AS scope_unit_id
    FROM {nation}
    """,
)


@query(
    "er_provenance_json",
    """
    SELECT n, email, phone, count(*) AS clusters FROM (
      SELECT cluster, 'source_priority' AS n,
             CASE WHEN max(email_address) IS NULL THEN NULL ELSE 'crm/longest' END AS email, cast(NULL AS string) AS phone
      FROM {nation_people} p GROUP BY cluster) x GROUP BY ALL
    """,
)
def er_provenance_json(t: Tables) -> DataFrame:
    """Source and strategy of each field as JSON, read back."""
    winners = survivorship.resolve_fields(t.nation_people, POLICY)
    ids = clusters.golden_ids(t.nation_people, "person")
    text = survivorship.provenance_json(winners, ids, POLICY)
    entry = lambda name, part: F.get_json_object("field_provenance", f"$.{name}.{part}")
    return (
        text.select(
            entry("full_name", "strategy").alias("n"),
            F.concat(entry("email_address", "source_id"), F.lit("/"), entry("email_address", "strategy")).alias("email"),
            entry("phone", "source_id").alias("phone"),
        )
        .groupBy("n", "email", "phone")
        .agg(F.count(F.lit(1)).alias("clusters"))
    )


@query(
    "field_modes",
    """
    SELECT 'all' AS mode, 's_suppkey,s_name,s_nationkey,s_acctbal' AS fields, count(*) AS rows FROM {supplier} a
    UNION ALL SELECT 'standard', 's_suppkey,s_name,s_nationkey', count(*) FROM {supplier} b
    UNION ALL SELECT 'custom', 's_acctbal', count(*) FROM {supplier} c
    UNION ALL SELECT 'includeOnly', 's_name', count(*) FROM {supplier} d
    """,
)
def field_modes(t: Tables) -> DataFrame:
    parts = None
    for mode in ("all", "standard", "custom", "includeOnly"):
        chosen = layers.select_fields(t.supplier, mode, include=("s_name",), custom=("s_acctbal",))
        row = chosen.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(mode).alias("mode"), F.lit(",".join(chosen.columns)).alias("fields"), "rows"
        )
        parts = row if parts is None else parts.unionByName(row)
    return parts


@query("layer_merge", _MERGED)
def layer_merge(t: Tables) -> DataFrame:
    """A base and a delta merged into a layer of key buckets, split by a small bound."""
    layer = KeyedLayer(t.spark, work_path(t.spark, "layer"), ["id"], bucket_bytes=512 << 10)
    for delta in (t.order_state, t.order_delta):
        layer.merge(delta, ["revision"], "is_delete")
    return layer.read().select(*t.order_state.columns)
