"""Prefix trie of conversations: a z-fast trie built in batches by Spark joins.

A turn is a symbol; a prefix of turns is named by a chained 128-bit digest, so a conversation is the
row of digests of its prefixes. The trie is kept compacted: one row per edge, that is per node with
its skip interval ``(start, extent]`` of depths. The handle of an edge is the prefix at the
two-fattest depth of that interval, the one with most trailing zeros in binary.

``build_edges`` inserts in rounds. Every conversation not yet in the trie finds its exit edge by fat
binary search: it probes the handles at the two-fattest depth of the interval still open, one join a
step, so a conversation of n turns needs at most ``bit_length(n)`` probes. The digests along the exit
edge tell where it leaves. All exits of a round cut their edges at once, and of all conversations
that leave at one place with the same next turn a hash-random one becomes the new leaf; the others
search again in the next round. A random choice leaves about half of what shares a path behind it,
so rounds grow with the logarithm of the conversations, however deep the trie.

``trie_nodes`` sums members, leaves and bytes from the edges to their ancestors and expands every edge
to its depths.

Scale: copies of a conversation are one row of the trie; their ids stay in the membership table. A
common first turn is one edge that many rows join to, from written tables, so that a join can be
split. One task streams all turns of a family of conversations that share a prefix, and holds 24 bytes
a turn of one conversation; and SHA-256 over the members that end at a node is one task a node, which
streams sorted ids.

Rows and edge cases: null roles and texts are empty. Turns are ordered by number, null first; equal
numbers are ordered by a hash of their role and text; repeated rows are turns of their own. Rows with
a null conversation id are one conversation, which is last among members, written ``null`` in the
digest and never the smallest member unless alone. An empty table has no nodes, not even a root.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.session import cut_lineage, drop_work

#: Bytes of a prefix digest.
WIDTH = 16
_PATHS = "conv long, n int, path binary, reach array<long>, tip binary"
_EDGES = "first binary, start int, extent int, label binary, last binary, top binary, handle binary, rep binary"
_NO_MEMBERS = hashlib.sha256().hexdigest()


def turn_symbols(
    conversations: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    base: Column | None = None,
    shared: Column | None = None,
) -> DataFrame:
    """``conv, turn, a, b, bytes, base, shared``: every turn as a hash, with the bytes of its text.

    With ``base`` and ``shared``, the first ``shared`` turns of a conversation are those of the
    conversation ``base`` (all if it has fewer, none if it is not there), in place of as many of its
    own. The base of a base must be that base.
    """
    role, text = (
        F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_column, text_column)
    )
    key = F.col(id_column).cast("long")
    return conversations.select(
        key.alias("conv"),
        F.col(turn_column).cast("long").alias("turn"),
        F.xxhash64(F.lit(0), role, text).alias("a"),
        F.xxhash64(F.lit(1), role, text).alias("b"),
        F.octet_length(text).cast("long").alias("bytes"),
        (key if base is None else base.cast("long")).alias("base"),
        F.coalesce(F.lit(0) if shared is None else shared.cast("int"), F.lit(0)).alias("shared"),
    )


def conversation_paths(symbols: DataFrame, most_shared: int = 8) -> DataFrame:
    """``conv, n, path, reach, tip``: digests of all prefixes and bytes up to each, by conversation.

    A base comes first among its family, so that the stream holds only its first ``most_shared``
    turns; a conversation that asks for more is an error.
    """
    rows = (
        symbols.withColumn("other", ~F.col("conv").eqNullSafe(F.col("base")))
        .repartition("base")
        .sortWithinPartitions("base", "other", "conv", "turn", "a", "b")
        .select("conv", "a", "b", "bytes", "base", "shared")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, family, opening, skip, seen = (), (), [], 0, 0
        path, reach, out, held = bytearray(), [], [], 0

        def put(a: int, b: int, size: int) -> None:
            data = bytes(path[-WIDTH:]) + struct.pack("<qq", a, b)
            path.extend(hashlib.blake2b(data, digest_size=WIDTH).digest())
            reach.append((reach[-1] if reach else 0) + size)

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["conv", "n", "path", "reach", "tip"],
            )

        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("conv", "a", "b", "bytes", "base", "shared"))
            for conv, a, b, size, base, shared in zip(*columns, strict=True):
                if (conv,) != here:
                    if here:
                        out.append((*here, len(reach), bytes(path), reach, bytes(path[-WIDTH:])))
                        held += 24 * len(reach) + 100
                    if held > 1 << 22:
                        yield flush()
                        out, held = [], 0
                    if (base,) != family:
                        family, opening = (base,), []
                    if shared > most_shared:
                        raise ValueError(f"conversation {conv} shares more than {most_shared} turns")
                    here, path, reach, skip, seen = (conv,), bytearray(), [], shared, 0
                    for turn in opening[:skip]:
                        put(*turn)
                if conv == base:
                    # Its own first turns are its opening; only those that others ask for stay.
                    if len(opening) < most_shared:
                        opening.append((a, b, size))
                    put(a, b, size)
                elif seen >= skip:
                    put(a, b, size)
                seen += 1
        if here:
            out.append((*here, len(reach), bytes(path), reach, bytes(path[-WIDTH:])))
        yield flush()

    return rows.mapInArrow(run, _PATHS)


def _digest(path: Column, depth: Column) -> Column:
    """The digest of the prefix of ``depth`` turns; empty at depth 0."""
    return F.when(depth > 0, F.substring(path, depth * WIDTH - (WIDTH - 1), F.lit(WIDTH))).otherwise(
        F.lit(b"")
    )


def fattest(low: Column, high: Column) -> Column:
    """The number in ``(low, high]`` with most trailing zeros in binary."""
    bits = F.length(F.bin(low.bitwiseXOR(high).cast("long"))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", high, bits), bits)


def _edge_columns() -> list[Column]:
    """An edge's columns from ``start, extent, label, top, rep``."""
    size = F.col("extent") - F.col("start")
    at = fattest(F.col("start"), F.col("extent")) - F.col("start")
    return [
        _digest(F.col("label"), F.lit(1)).alias("first"),
        "start",
        "extent",
        "label",
        _digest(F.col("label"), size).alias("last"),
        "top",
        _digest(F.col("label"), at).alias("handle"),
        "rep",
    ]


def _exits(rest: DataFrame, edges: DataFrame, longest: int) -> DataFrame:
    """``tip, n, path, edge, leave, next``: where each path leaves the trie.

    ``edge`` is the exit edge (null at a node), ``leave`` the depth, ``next`` the prefix one deeper,
    null for a path that ends there.
    """
    handles = edges.select(
        F.col("handle").alias("_probe"),
        F.col("start").alias("_start"),
        F.col("extent").alias("_extent"),
        F.col("last").alias("_last"),
    )
    state = rest.select("tip", "n", "path", F.lit(0).alias("low"), F.col("n").alias("high"))
    for _ in range(longest.bit_length()):
        probe = fattest(F.col("low"), F.col("high"))
        # A path that has ended its search joins by its own tip, which spreads such rows.
        key = F.when(F.col("low") < F.col("high"), _digest(F.col("path"), probe))
        state = state.withColumns({"at": probe, "_probe": F.coalesce(key, "tip")})
        hit = F.col("_extent").isNotNull()
        inside = (F.col("_extent") <= F.col("n")) & (
            _digest(F.col("path"), F.col("_extent")) == F.col("_last")
        )
        low = F.when(hit & inside, F.col("_extent")).when(hit, F.col("_start")).otherwise(F.col("low"))
        high = (
            F.when(hit & inside, F.col("high")).when(hit, F.col("_start")).otherwise(F.col("at") - 1)
        )
        searching = F.col("low") < F.col("high")
        state = state.join(handles, "_probe", "left").select(
            "tip",
            "n",
            "path",
            F.when(searching, low).otherwise(F.col("low")).alias("low"),
            F.when(searching, high).otherwise(F.col("high")).alias("high"),
        )
    exits = edges.select(F.col("first").alias("_first"), "start", "extent", "label")
    after = F.when(F.col("low") < F.col("n"), _digest(F.col("path"), F.col("low") + 1))
    state = state.withColumn("_first", F.coalesce(after, "tip")).join(exits, "_first", "left")
    on_edge = F.col("start").isNotNull() & (F.col("low") < F.col("n"))
    steps = F.sequence(F.lit(1), F.least("extent", "n") - F.col("start"))
    same = F.filter(
        steps, lambda i: _digest(F.col("label"), i) == _digest(F.col("path"), F.col("start") + i)
    )
    leave = F.when(on_edge, F.col("start") + F.size(same)).otherwise(F.col("low"))
    return state.withColumn("leave", leave).select(
        "tip",
        "n",
        "path",
        F.when(on_edge, F.col("_first")).alias("edge"),
        "leave",
        F.when(leave < F.col("n"), _digest(F.col("path"), F.col("leave") + 1)).alias("next"),
    )


def _cut(edges: DataFrame, exits: DataFrame) -> DataFrame:
    """The edges, cut at every depth where a path leaves them."""
    cuts = (
        exits.where(F.col("edge").isNotNull())
        .groupBy(F.col("edge").alias("first"))
        .agg(F.collect_set("leave").alias("cuts"))
    )
    joined = edges.join(cuts, "first", "left").withColumn(
        "ends", F.concat(F.coalesce(F.array_sort("cuts"), F.array().cast("array<int>")), F.array("extent"))
    )
    bounds = F.transform(
        "ends",
        lambda end, i: F.struct(
            F.when(i == 0, F.col("start")).otherwise(F.get("ends", i - 1)).alias("start"),
            end.alias("extent"),
        ),
    )
    parts = joined.select(F.col("start").alias("begin"), "label", "top", "rep", F.explode(bounds).alias("part"))
    offset = F.col("part.start") - F.col("begin")
    label = F.substring(
        "label", offset * WIDTH + 1, (F.col("part.extent") - F.col("part.start")) * WIDTH
    )
    top = F.when(offset > 0, _digest(F.col("label"), offset)).otherwise(F.col("top"))
    return parts.select(
        "part.start", "part.extent", label.alias("label"), top.alias("top"), "rep"
    ).select(*_edge_columns())


def build_edges(paths: DataFrame) -> DataFrame:
    """The compacted trie of ``tip, n, path``, one row per distinct path that is not empty."""
    spark = paths.sparkSession
    rest = paths.where(F.col("n") > 0).select("tip", "n", "path")
    longest = rest.agg(F.max("n")).first()[0] or 0
    edges = spark.createDataFrame([], _EDGES)
    exits = None
    while longest:
        found = cut_lineage(_exits(rest, edges, longest), "exits")
        if exits is not None:
            drop_work(exits)
        exits = found
        if exits.isEmpty():
            drop_work(exits)
            break
        # The hash-random path of each place becomes the leaf; a tip names one path.
        chosen = (
            exits.where(F.col("next").isNotNull())
            .groupBy("next")
            .agg(F.min(F.struct(F.xxhash64("tip").alias("spot"), "tip")).alias("one"))
            .select("one.tip")
        )
        leaves = exits.join(chosen, "tip", "left_semi").select(
            F.col("leave").alias("start"),
            F.col("n").alias("extent"),
            F.substring("path", F.col("leave") * WIDTH + 1, (F.col("n") - F.col("leave")) * WIDTH).alias(
                "label"
            ),
            _digest(F.col("path"), F.col("leave")).alias("top"),
            F.col("tip").alias("rep"),
        )
        grown = cut_lineage(_cut(edges, exits).unionByName(leaves.select(*_edge_columns())), "edges")
        if edges.inputFiles():
            drop_work(edges)
        edges = grown
        rest = exits.where(F.col("next").isNotNull()).join(chosen, "tip", "left_anti")
    return edges


def _end_digests(members: DataFrame) -> DataFrame:
    """``tip, ends``: SHA-256 of the ids of the conversations that end at each tip."""
    rows = members.repartition("tip").sortWithinPartitions("tip", F.col("conv").asc_nulls_last())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = state = None
        for batch in batches:
            tips, ends = [], []
            for tip, conv in zip(batch["tip"].to_pylist(), batch["conv"].to_pylist(), strict=True):
                name = b"null" if conv is None else b"%d" % conv
                if tip == here:
                    state.update(b"," + name)
                    continue
                if state is not None:
                    tips.append(here)
                    ends.append(state.hexdigest())
                here, state = tip, hashlib.sha256(name)
            yield pa.RecordBatch.from_pydict({"tip": pa.array(tips, pa.binary()), "ends": pa.array(ends, pa.string())})
        if state is not None:
            yield pa.RecordBatch.from_pydict({"tip": pa.array([here], pa.binary()), "ends": [state.hexdigest()]})

    return rows.select("tip", "conv").mapInArrow(run, "tip binary, ends string")


def trie_nodes(symbols: DataFrame) -> DataFrame:
    """One row for every distinct prefix of turns, from the symbols of ``turn_symbols``.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (bytes that need not be computed again in the subtree) and
    ``ends_sha256`` (over the ids of the conversations that end here, ascending, with commas).
    """
    paths = cut_lineage(conversation_paths(symbols), "paths")
    copies = paths.groupBy("tip").agg(
        F.count(F.lit(1)).alias("copies"), F.min("conv").alias("smallest")
    )
    # One row for each distinct path: that of the smallest member.
    distinct = cut_lineage(
        copies.join(paths.withColumnRenamed("tip", "own"),
                    (F.col("tip") == F.col("own")) & F.col("smallest").eqNullSafe(F.col("conv")))
        .select("tip", "n", "path", "reach", "copies", "smallest"),
        "distinct",
    )
    edges = build_edges(distinct)
    children = edges.groupBy(F.col("top").alias("node")).agg(F.count(F.lit(1)).alias("children"))
    own = distinct.select(
        F.col("tip").alias("node"),
        "copies",
        "smallest",
        (F.col("copies") * F.coalesce(F.try_element_at("reach", F.lit(-1)), F.lit(0))).alias("walked"),
    )
    # The root is an edge of no length, so that sums and ends need no case of its own.
    root = paths.groupBy().agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    along = (
        edges.join(distinct.select(F.col("tip").alias("rep"), "path", "reach"), "rep")
        .select("start", "extent", F.col("last").alias("node"), "top", "path", "reach")
        .unionByName(
            root.select(
                F.lit(0).alias("start"),
                F.lit(0).alias("extent"),
                F.lit(b"").alias("node"),
                F.lit(None).cast("binary").alias("top"),
                F.lit(b"").alias("path"),
                F.array().cast("array<long>").alias("reach"),
            )
        )
    )

    def bytes_to(depth: Column) -> Column:
        return F.when(depth > 0, F.get("reach", depth - 1)).otherwise(F.lit(0).cast("long"))

    nodes = cut_lineage(along.join(children, "node", "left").join(own, "node", "left"), "nodes")
    sums = (
        nodes.select(
            F.coalesce("copies", F.lit(0)).alias("copies"),
            "smallest",
            F.coalesce("walked", F.lit(0)).alias("walked"),
            F.when(F.col("children").isNull(), 1).otherwise(0).alias("leaf"),
            (bytes_to(F.col("extent")) - bytes_to(F.col("start"))).alias("held"),
            F.explode(
                F.transform(F.sequence(F.lit(0), F.col("extent")), lambda d: _digest(F.col("path"), d))
            ).alias("node"),
        )
        .groupBy("node")
        .agg(
            F.sum("copies").alias("n_convs"),
            F.min("smallest").alias("conv_id"),
            F.sum("leaf").cast("long").alias("n_leaves"),
            F.sum("walked").alias("walked"),
            F.sum("held").alias("held"),
        )
    )
    summed = cut_lineage(sums.join(nodes.select("node"), "node", "left_semi"), "sums")
    ends = _end_digests(paths.select("conv", "tip")).withColumnRenamed("tip", "node")
    full = (
        nodes.select("node", "top", "start", "extent", "reach", "children")
        .join(summed, "node")
        .join(ends, "node", "left")
        .join(summed.select(F.col("node").alias("top"), F.col("conv_id").alias("above")), "top", "left")
    )
    depths = F.sequence(F.least(F.col("start") + 1, F.col("extent")), F.col("extent"))
    depth, before = F.col("depth"), F.greatest(F.col("depth") - 1, F.lit(0))
    extent = F.col("extent")
    saved = (
        F.col("walked")
        - F.col("n_convs") * bytes_to(before)
        - (F.col("held") - (bytes_to(before) - bytes_to(F.least("start", before))))
    )
    return full.withColumn("depth", F.explode(depths)).select(
        "conv_id",
        depth.cast("long").alias("depth"),
        F.when(depth == F.col("start") + 1, F.col("above"))
        .when(depth > 0, F.col("conv_id"))
        .alias("parent_conv_id"),
        "n_convs",
        F.when(depth == extent, F.coalesce("children", F.lit(0))).otherwise(1).cast("long").alias("n_children"),
        "n_leaves",
        saved.cast("long").alias("saved_tokens"),
        F.when(depth == extent, F.coalesce("ends", F.lit(_NO_MEMBERS)))
        .otherwise(F.lit(_NO_MEMBERS))
        .alias("ends_sha256"),
    )
