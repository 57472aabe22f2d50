"""Mixing sources to target weights with Spark functions only.

Every document gets a hash-random key. The documents of a source are ranged by that key into
buckets of bounded size, sorted inside the bucket, and numbered by prefix sums of their sizes:
sums per bucket, a running sum over buckets, a running sum inside each bucket. A source is taken
whole as often as its target allows; of the last round it gives the documents whose middle lies
before the exact budget, so the error is at most half a document. Only bucket sums meet in one task
per source, and a source that holds a third of all rows is spread over all its buckets.

Rows and edge cases: null text has size 0 and is never taken. A null source is a source of its own,
after all others. Rows that repeat an id are separate documents (ordered by id, text hash, then a
hash of the whole row); of n equal rows the mix takes as many copies as their n rows of the plan
have together. An empty table gives an empty result. Other columns are kept by ``mix_sources`` only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarnlake.session import cut_lineage

_WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """``source, source_size, target`` from one row per source.

    Sources by code point, null last, weigh ``weights`` in turn and share the sum of all sizes.
    A target stops at ``most`` times the size and the excess is shared anew by weight. With targets
    ``min(most * size, level * weight)`` the sources stop in the order of ``size / weight``; the
    level follows from running sums over the sources that stop before.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    places = sizes.withColumn("place", F.row_number().over(in_order) - 1)
    shares = F.array(*[F.lit(float(w)) for w in weights])
    weighed = places.withColumn("weight", F.get(shares, F.col("place") % len(weights)))
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    total = F.sum("source_size").over(every)
    left = total - F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0.0))
    share = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    limit = most * F.col("source_size")
    # The first source whose limit is above the level it would get ends the filling.
    trial = weighed.withColumn("level", left / share).withColumn("limit", limit)
    level = F.min(
        F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct("room", "place", "level"))
    ).over(every)["level"]
    return (
        trial.withColumn("room", F.col("source_size") / F.col("weight"))
        .withColumn("end", level)
        .select(
            "source",
            "source_size",
            F.coalesce(F.least("limit", F.col("end") * F.col("weight")), F.col("limit")).alias("target"),
        )
    )


def mix_plan(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[float] = (1, 2, 3),
    most: float = 3.0,
    seed: str = "mix",
    bucket_rows: int = 4_000,
) -> DataFrame:
    """``id, text_hash, source, size, source_size, target, copies, row_hash``, one row per document row."""
    narrow = documents.select(
        _row_hash(documents).alias("row_hash"),
        F.col(id_column).alias("id"),
        F.xxhash64(F.col(text_column)).alias("text_hash"),
        F.col(source_column).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_column), F.lit(_WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(
            F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
        ).alias("key"),
    )
    base = cut_lineage(narrow)
    sizes = base.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")
    )
    targets = source_targets(sizes.select("source", "source_size"), weights, most)
    plan = targets.join(
        sizes.select(F.col("source").alias("s"), "rows"), F.col("source").eqNullSafe(F.col("s"))
    ).select(
        F.col("source").alias("named"),
        "source_size",
        "target",
        F.ceil(F.col("rows") / bucket_rows).alias("buckets"),
    )
    # 32 bits of the key scaled to the number of buckets: equal ranges of keys.
    lead = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    ranged = base.join(plan, F.col("source").eqNullSafe(F.col("named"))).withColumn(
        "bucket", F.shiftright(lead * F.col("buckets"), 32)
    )
    cells = ranged.groupBy("named", "bucket").agg(F.sum("size").alias("cell"))
    ahead = Window.partitionBy("named").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(
        F.col("named").alias("o_named"),
        F.col("bucket").alias("o_bucket"),
        F.coalesce(F.sum("cell").over(ahead), F.lit(0)).alias("offset"),
    )
    inside = (
        Window.partitionBy("named", "bucket")
        .orderBy("key", F.col("id").asc_nulls_first(), "text_hash", "row_hash")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = ranged.join(
        offsets,
        F.col("named").eqNullSafe(F.col("o_named")) & (F.col("bucket") == F.col("o_bucket")),
    ).withColumn("start", F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    budget = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - whole * F.col("source_size")
    middle: Column = 2 * F.col("start") + F.col("size")
    last = F.when((F.col("size") > 0) & (middle <= 2 * rest), 1).otherwise(0)
    return placed.select(
        "id", "text_hash", "source", "size", "source_size", "target", (whole + last).alias("copies"),
        "row_hash",
    )


def _row_hash(documents: DataFrame, prefix: str = "") -> Column:
    return F.xxhash64(*[F.col(f"{prefix}`{c}`") for c in documents.columns])


def mix_sources(documents: DataFrame, **options) -> DataFrame:
    """The mixed rows: every document as often as the plan says, with its own columns."""
    id_column = options.get("id_column", "doc_id")
    keys = ["id", "text_hash", "source", "row_hash"]
    chosen = cut_lineage(
        mix_plan(documents, **options)
        .groupBy(*keys)
        .agg(F.sum("copies").cast("int").alias("copies"), F.count(F.lit(1)).alias("rows"))
        .where(F.col("copies") > 0)
    )
    d, p = documents.alias("d"), chosen.alias("p")
    joined = d.join(
        p,
        F.col(f"d.`{id_column}`").eqNullSafe(F.col("p.id"))
        & (_row_hash(documents, "d.") == F.col("p.row_hash")),
    )
    taken = joined.where(F.col("p.rows") == 1).select("d.*", F.col("p.copies").alias("_copies"))
    if not chosen.where("rows > 1").isEmpty():
        # One of n equal rows stands for all of them.
        equal = joined.where(F.col("p.rows") > 1).select("d.*", F.col("p.copies").alias("_copies"))
        taken = taken.unionByName(equal.distinct())
    copies = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    return taken.withColumn("_copies", copies).drop("_copies")
