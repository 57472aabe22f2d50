"""Connected components over links, golden ids and their history."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.operators.matching import RECORD_ID
from tarnlake.session import cut_lineage, drop_work

#: Edges that one task can hold; their components are one job instead of several for each round.
ONE_TASK_EDGES = 1 << 20
_BATCH_ROWS = 1 << 15


def _fingerprint(edges: DataFrame) -> tuple:
    """Size and hash sum of an edge set: one row, whatever its size."""
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _stars(edges: DataFrame) -> DataFrame:
    """``u, v``: every node of the edges but the smallest of its component, and that one, by one task.

    The ids are numbered in their order. In each round every root with a smaller root beside it hangs
    on the smallest one, which at least halves the roots of a component that are left.
    """

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        ends = pa.chunked_array([b["u"] for b in held] + [b["v"] for b in held]).dictionary_encode().combine_chunks()
        order = pc.sort_indices(ends.dictionary)
        names = ends.dictionary.take(order)
        number = np.empty(len(names), np.int64)
        number[order.to_numpy()] = np.arange(len(names))
        a, b = np.split(number[ends.indices.to_numpy()], 2)
        root = np.arange(len(names))
        while True:
            above = root.copy()
            np.minimum.at(above, root[a], root[b])
            np.minimum.at(above, root[b], root[a])
            while not np.array_equal(above, higher := above[above]):
                above = higher
            if np.array_equal(above, root):
                break
            root = above
        below = np.flatnonzero(root != np.arange(len(names)))
        for start in range(0, len(below), _BATCH_ROWS):
            at = below[start : start + _BATCH_ROWS]
            yield pa.RecordBatch.from_arrays([names.take(pa.array(at)), names.take(pa.array(root[at]))], ["u", "v"])

    return edges.coalesce(1).mapInArrow(solve, edges.schema)


def connected_components(
    nodes: DataFrame, links: DataFrame, node: str = RECORD_ID, one_task: int = 0
) -> DataFrame:
    """``node`` and ``cluster``, the smallest node id it is connected to; lone nodes stand alone.

    Up to ``one_task`` distinct edges are solved by one task (``_stars``). More take rounds:

    alternating large-star and small-star rounds (Kiveris et al., 2014), where neighbours are re-linked
    to the smallest known id until every component is a star. The smallest neighbour is an
    aggregate with map-side combine joined back, so a node with very many neighbours needs no list,
    and each round ends in a reliable checkpoint.
    """
    a, b = F.col("record_a_id"), F.col("record_b_id")
    edges = cut_lineage(
        links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    state = _fingerprint(edges)
    if 0 < state[0] <= one_task:
        before, edges, state = edges, cut_lineage(_stars(edges)), (0,)
        drop_work(before)
    while state[0] > 0:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = _smallest(both).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(near, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        lowest = _smallest(large)
        moved = (
            large.join(lowest, "u")
            .where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        before, edges = edges, cut_lineage(
            moved.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
        )
        drop_work(before)
        now = _fingerprint(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("u").alias(node), F.col("v").alias("_root"))
    return nodes.select(node).join(roots, node, "left").select(
        node, F.coalesce("_root", node).alias("cluster")
    )


def golden_ids(
    membership: DataFrame,
    entity_type: str,
    namespace: str = "_source_id",
    node: str = RECORD_ID,
) -> DataFrame:
    """``cluster, golden_id, member_count`` per cluster.

    The id is ``gid-`` and 16 hex digits of the SHA-256 over namespace, entity type and the sorted
    member ids, for clusters of any size: the members are sorted by ranges, so that a large cluster
    is spread over tasks, and each range is joined to pieces of text. Only the pieces of a cluster
    meet in one task, where they run through the hash as a stream. Who belongs to a cluster is in
    ``membership``.
    """
    prefix = f"{namespace}:{entity_type}:".encode()
    kind = membership.schema["cluster"].dataType
    schema = T.StructType(
        [
            T.StructField("cluster", kind),
            T.StructField("golden_id", T.StringType()),
            T.StructField("member_count", T.LongType()),
        ]
    )
    piece = T.StructType(
        [
            T.StructField("cluster", kind),
            T.StructField("at", T.LongType()),
            T.StructField("body", T.StringType()),
            T.StructField("members", T.LongType()),
        ]
    )
    ordered = (
        membership.select("cluster", F.col(node).cast("string").alias("member"))
        .repartitionByRange("cluster", "member")
        .sortWithinPartitions("cluster", "member")
        .withColumn("at", F.monotonically_increasing_id())
    )

    def join(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            done: list[tuple] = []
            here, first, held = None, 0, []
            rows = zip(frame["cluster"], frame["member"], frame["at"], strict=True)
            for cluster, member, at in rows:
                if held and cluster != here:
                    done.append((here, first, "|".join(held), len(held)))
                    held = []
                if not held:
                    here, first = cluster, at
                held.append(member)
            if held:
                done.append((here, first, "|".join(held), len(held)))
            yield pd.DataFrame(done, columns=piece.names)

    def digest(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, state, count = None, None, 0
        for frame in frames:
            done = []
            for cluster, body, members in zip(frame["cluster"], frame["body"], frame["members"], strict=True):
                if state is None or cluster != here:
                    if state is not None:
                        done.append((here, f"gid-{state.hexdigest()[:16]}", count))
                    here, state, count = cluster, hashlib.sha256(prefix), 0
                else:
                    state.update(b"|")
                state.update(body.encode())
                count += members
            yield pd.DataFrame(done, columns=schema.names)
        if state is not None:
            last = (here, f"gid-{state.hexdigest()[:16]}", count)
            yield pd.DataFrame([last], columns=schema.names)

    pieces = ordered.mapInPandas(join, piece).repartition("cluster").sortWithinPartitions("cluster", "at")
    return pieces.mapInPandas(digest, schema)


def golden_id_events(previous: DataFrame, current: DataFrame, node: str = RECORD_ID) -> DataFrame:
    """How golden ids of one run follow from those of the run before.

    Both inputs are ``(node, golden_id)``. One row per current id and previous id that shares
    members with it: ``merge`` when several previous ids went into the current one, ``split`` when
    the previous id went into several, else ``assign``; a new id has no previous id. Unchanged ids
    have no row.
    """
    flow = (
        current.select(node, "golden_id")
        .join(previous.select(node, F.col("golden_id").alias("previous_golden_id")), node, "left")
        .groupBy("golden_id", "previous_golden_id")
        .agg(F.count(F.lit(1)).alias("records"))
    )
    into = flow.groupBy("golden_id").agg(F.count("previous_golden_id").alias("_sources"))
    out = (
        flow.where(F.col("previous_golden_id").isNotNull())
        .groupBy("previous_golden_id")
        .agg(F.count(F.lit(1)).alias("_targets"))
    )
    joined = flow.join(into, "golden_id").join(out, "previous_golden_id", "left")
    operation = (
        F.when(F.col("_sources") > 1, "merge").when(F.col("_targets") > 1, "split").otherwise("assign")
    )
    return (
        joined.withColumn("operation", operation)
        .where(
            (F.col("operation") != "assign")
            | ~F.col("golden_id").eqNullSafe(F.col("previous_golden_id"))
        )
        .select("golden_id", "previous_golden_id", "operation", "records")
    )
