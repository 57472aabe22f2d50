"""Similarity join of documents on word n-grams with a token-group matrix.

1. Every document becomes the set of its distinct word n-grams (64-bit hashes). Documents with the
   same set are one class, stood for by its smallest id.
2. A global token order (rarest first, by counts over the whole corpus) gives every set a prefix
   so long that two sets of the required similarity share a prefix token. The order only decides
   the work, never the result: any order that all sets share is exact.
3. Sets are partitioned into groups of similar sets: every token names as its hub the set whose
   tokens are shared most, each set is compared with the hub it shares most tokens with, and linked
   sets form a group. Among copies of one text the hub is the text the others derive from.
4. The matrix holds, for every token that more than one group has, the groups whose token union has
   it, with size range and best place. A set opens a group only if the bound on their overlap
   reaches what the similarity asks for, and is then compared with the members behind those tokens.
5. Links of steps 3 and 4 give the components.

Sets inside one group are connected already and never paired again, so a group of n near copies
costs about n comparisons, and a passage that many unlike documents share falls behind the prefixes.

Rows and edge cases: null, empty or blank text has no set and no links. Fewer words than the n-gram
length: the whole sequence is the one n-gram. A null id gives a count and a null component. Rows
that repeat an id with the same text are one node; with different texts they share that id's node.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tarnlake.llm.arrays import Windows, mix, runs, signed, words_of
from tarnlake.operators.clusters import connected_components
from tarnlake.session import cut_lineage

#: Buckets of the token counts that order the prefixes, and bits of the candidate filter.
_COUNT_BITS = 20
_FILTER_BITS = 23

_SIGNATURES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("n", T.LongType(), False),
        T.StructField("d1", T.LongType(), False),
        T.StructField("d2", T.LongType(), False),
        T.StructField("prefix", T.ArrayType(T.LongType(), False), False),
    ]
)
_SETS = "id long, tokens binary"


def _row_sets(
    data: np.ndarray, offsets: np.ndarray, size: int, wanted: np.ndarray | None = None
) -> Iterator[np.ndarray]:
    """The sorted n-gram set of each row; empty where ``wanted`` is false."""
    words = words_of(data, offsets, lower=True)
    hashes = Windows(words.hashes())
    at = words.windows(size)
    grams = hashes.hashes(at, at + size)
    cuts = np.searchsorted(at, words.first)
    for row, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
        if a == b or (wanted is not None and not wanted[row]):
            yield np.empty(0, np.uint64)
        elif b - a < size:
            yield hashes.hashes(np.array([a]), np.array([b]))
        else:
            yield np.unique(grams[cuts[row] : cuts[row + 1]])


def _token_counts(texts: DataFrame, size: int) -> np.ndarray:
    """How often the tokens of each hash bucket occur in the corpus: one array of fixed size."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << _COUNT_BITS, np.int64)
        for _, data, offsets in runs(batches):
            words = words_of(data, offsets, lower=True)
            at = words.windows(size)
            grams = Windows(words.hashes()).hashes(at, at + size)
            buckets = (grams >> np.uint64(64 - _COUNT_BITS)).astype(np.int64)
            total += np.bincount(buckets, minlength=len(total))
        packed = np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array([packed.tobytes()], pa.binary())], names=["counts"])

    def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a + np.minimum(b, np.iinfo(np.uint32).max - a)

    parts = texts.select("text").mapInArrow(count, "counts binary").rdd
    empty = np.zeros(1 << _COUNT_BITS, np.uint32)
    return parts.map(lambda row: np.frombuffer(row[0], np.uint32)).treeAggregate(empty, add, add)


def _signatures(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Id, set size, 128-bit digest of the set and its prefix in the global order."""
    counts = texts.sparkSession.sparkContext.broadcast(_token_counts(texts, size))
    shift, salt = np.uint64(64 - _COUNT_BITS), np.uint64(0x5851F42D4C957F2D)

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = counts.value
        for batch, data, offsets in runs(batches):
            sizes, first, second, prefixes = [], [], [], []
            for grams in _row_sets(data, offsets, size):
                n = len(grams)
                keep = n - (percent * n + 99) // 100 + 1 if n else 0
                order = np.argsort(rank[grams >> shift], kind="stable")[:keep]
                sizes.append(n)
                first.append(np.add.reduce(mix(grams)))
                second.append(np.add.reduce(mix(grams ^ salt)))
                prefixes.append(signed(grams[order]))
            ends = np.cumsum([0, *map(len, prefixes)], dtype=np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(signed(np.array(first, np.uint64))),
                    pa.array(signed(np.array(second, np.uint64))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64())),
                ],
                names=["id", "n", "d1", "d2", "prefix"],
            )

    return texts.mapInArrow(sign, _SIGNATURES)


def _id_slots(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


def _id_filter(ids: DataFrame) -> np.ndarray:
    """A bit set of fixed size that has all ids of the column, and by chance others."""

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << _FILTER_BITS, bool)
        for batch in batches:
            seen[_id_slots(batch.column(0).to_numpy(zero_copy_only=False))] = True
        bits = np.packbits(seen).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([bits], pa.binary())], names=["bits"])

    parts = ids.mapInArrow(gather, "bits binary").rdd
    empty = np.zeros(1 << (_FILTER_BITS - 3), np.uint8)
    return parts.map(lambda row: np.frombuffer(row[0], np.uint8)).treeAggregate(
        empty, np.bitwise_or, np.bitwise_or
    )


def _sets(texts: DataFrame, bits: np.ndarray, size: int) -> DataFrame:
    """The n-gram sets of the rows whose id may be asked for."""
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.unpackbits(shared.value).astype(bool)
        for batch, data, offsets in runs(batches):
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            wanted = asked[_id_slots(ids)]
            if not wanted.any():
                continue
            sets = [x.tobytes() for x in _row_sets(data, offsets, size, wanted)]
            at = np.flatnonzero(wanted)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at], pa.int64()), pa.array([sets[i] for i in at], pa.binary())],
                names=["id", "tokens"],
            )

    return texts.where(F.col("id").isNotNull()).mapInArrow(build, _SETS)


def _links(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity, by exact intersection."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    sets = _sets(texts, _id_filter(ids), size)
    both = (
        pairs.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("left")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("tokens").alias("right")), "b")
        .select("a", "b", "left", "right")
    )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                x = np.frombuffer(left.as_buffer(), np.uint64)
                y = np.frombuffer(right.as_buffer(), np.uint64)
                shared = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], names=["a", "b"]
            ).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(compare, "a long, b long")


def _may_reach(percent: int, a: str, b: str):
    """Size ratio and places of a shared token allow the similarity; ``a`` and ``b`` hold n and p.

    At the first common token at most what is left of either set can be common; the overlap must be
    at least percent / (100 + percent) of both sizes together.
    """
    na, nb = F.col(f"{a}n"), F.col(f"{b}n")
    left = F.least(na - F.col(f"{a}p"), nb - F.col(f"{b}p"))
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (
        (100 + percent) * left >= percent * (na + nb)
    )


def _matrix(reps: DataFrame) -> DataFrame:
    """Prefix tokens that more than one set has: ``token, id, n, p`` and the number of sets ``c``."""
    tokens = reps.select("id", "n", F.posexplode("prefix").alias("p", "token"))
    sets = F.count(F.lit(1)).over(Window.partitionBy("token"))
    return tokens.withColumn("c", sets).where(F.col("c") > 1).select("token", "id", "n", "p", "c")


def _hub_pairs(matrix: DataFrame, percent: int) -> DataFrame:
    """For each set the hub it shares most prefix tokens with.

    A set scores the other sets behind all its tokens; the hub of a token has the highest score.
    """
    scores = matrix.groupBy("id").agg(F.sum(F.col("c") - 1).alias("score"))
    order = Window.partitionBy("token").orderBy(F.desc("score"), "n", "id")
    hub = F.first(F.struct("id", "n", "p")).over(order)
    rows = (
        matrix.join(scores, "id")
        .withColumn("hub", hub)
        .select("id", "n", "p", *(F.col(f"hub.{c}").alias(f"h{c}") for c in ("id", "n", "p")))
        .where((F.col("id") != F.col("hid")) & _may_reach(percent, "", "h"))
    )
    counted = rows.groupBy("id", "hid").agg(F.count(F.lit(1)).alias("c"))
    best = counted.groupBy("id").agg(F.max(F.struct("c", "hid")).alias("m"))
    return best.select(
        F.least("id", "m.hid").alias("a"), F.greatest("id", "m.hid").alias("b")
    ).distinct()


def _open_pairs(matrix: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs of a set and a member of another group that the matrix lets it open."""
    known = (
        matrix.select("token", "id", "n", "p")
        .join(groups, "id", "left")
        .withColumn("group", F.coalesce("group", "id"))
    )
    mixed = (
        known.groupBy("token")
        .agg(F.min("group").alias("lo"), F.max("group").alias("hi"))
        .where(F.col("lo") != F.col("hi"))
    )
    rows = cut_lineage(known.join(mixed.select("token"), "token", "left_semi"))
    # One entry of the matrix: a group that has the token, its member sizes and best place.
    union = rows.groupBy("token", "group").agg(
        F.min("n").alias("least"),
        F.max("n").alias("most"),
        F.max(F.col("n") - F.col("p")).alias("rest"),
    )
    x, g, y = rows.alias("x"), union.alias("g"), rows.alias("y")
    opened = x.join(
        g,
        (F.col("x.token") == F.col("g.token"))
        & (F.col("x.group") != F.col("g.group"))
        & (100 * F.col("x.n") >= percent * F.col("g.least"))
        & (100 * F.col("g.most") >= percent * F.col("x.n"))
        & (
            (100 + percent) * F.least(F.col("x.n") - F.col("x.p"), F.col("g.rest"))
            >= percent * (F.col("x.n") + F.col("g.least"))
        ),
    ).select("x.token", "x.id", "x.n", "x.p", F.col("g.group").alias("group"))
    smaller = (F.col("y.n") < F.col("o.n")) | (
        (F.col("y.n") == F.col("o.n")) & (F.col("y.id") < F.col("o.id"))
    )
    return (
        opened.alias("o")
        .join(
            y,
            (F.col("o.token") == F.col("y.token"))
            & (F.col("o.group") == F.col("y.group"))
            & smaller
            & _may_reach(percent, "y.", "o."),
        )
        .select(F.least("o.id", "y.id").alias("a"), F.greatest("o.id", "y.id").alias("b"))
        .distinct()
    )


def _components(links: DataFrame) -> DataFrame:
    """``id, group`` for all linked ids; the group is the smallest id."""
    named = links.select(F.col("a").alias("record_a_id"), F.col("b").alias("record_b_id"))
    nodes = links.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    return cut_lineage(connected_components(nodes, named, "id").withColumnRenamed("cluster", "group"))


def _merged(groups: DataFrame, far: DataFrame) -> DataFrame:
    """The groups after the links between them: the links are lifted to groups first."""
    at = {
        side: groups.select(F.col("id").alias(side), F.col("group").alias(f"g{side}"))
        for side in ("a", "b")
    }
    lifted = far.join(at["a"], "a", "left").join(at["b"], "b", "left").select(
        F.coalesce("ga", "a").alias("a"), F.coalesce("gb", "b").alias("b")
    )
    above = _components(lifted.distinct())
    alone = far.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    every = groups.unionByName(
        alone.join(groups, "id", "left_anti").select("id", F.col("id").alias("group"))
    )
    top = above.select(F.col("id").alias("group"), F.col("group").alias("top"))
    return every.join(top, "group", "left").select("id", F.coalesce("top", "group").alias("group"))


def jaccard_components(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``id_column, n_shingles, component_id`` for every row of ``documents``.

    ``component_id`` is the smallest id reachable over links, where two documents link if
    ``100 * |A & B| >= percent * |A | B|`` on their sets of ``size`` consecutive words.
    """
    spark: SparkSession = documents.sparkSession
    if not 50 <= percent <= 100 or size < 1:
        raise ValueError("percent must lie between 50 and 100 and size be positive")
    texts = documents.select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text")
    )
    signed_rows = cut_lineage(_signatures(texts, size, percent))
    known = signed_rows.where((F.col("n") > 0) & F.col("id").isNotNull())
    classes = known.groupBy("n", "d1", "d2").agg(F.min("id").alias("rep"))
    rep_ids = classes.select(F.col("rep").alias("id"))
    reps = known.join(rep_ids, "id", "left_semi").select("id", "n", "prefix")
    matrix = cut_lineage(_matrix(reps))
    near = cut_lineage(_links(cut_lineage(_hub_pairs(matrix, percent)), texts, size, percent))
    groups = _components(near)
    far = cut_lineage(
        _links(cut_lineage(_open_pairs(matrix, groups, percent)), texts, size, percent)
    )
    final = _merged(groups, far)
    membership = classes.join(
        final.select(F.col("id").alias("rep"), "group"), "rep", "left"
    ).select("n", "d1", "d2", F.coalesce("group", "rep").alias("component_id"))
    counted = signed_rows.select("id", "n", "d1", "d2")
    return counted.join(membership, ["n", "d1", "d2"], "left").select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
    )
