"""Line deduplication across documents with Spark functions only.

Lines are exploded as 128-bit hashes of their keys, counted once per document, and only the line
places that must go travel back to the documents; the text itself is shuffled once, for the last
join. Counting per (hash, document) and then per hash combines before each shuffle, so a line that a
third of all documents has costs one row per document.

Rows and edge cases: null or empty text is one empty line. A null id counts as one document that is
smaller than all others. Rows that repeat an id count as one document for a line, and lines are
dropped from each of them. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.session import cut_lineage

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends and with A-Z in lower case."""
    bare = F.btrim(line, F.lit(_BLANKS))
    plain = F.octet_length(bare) == F.length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def drop_common_lines(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_chars: int = 20,
    min_documents: int = 3,
) -> DataFrame:
    """``id_column, text, n_lines, n_dropped`` for every row of ``documents``.

    Keys of at least ``min_chars`` code points in at least ``min_documents`` documents lose their
    lines in all documents but the one with the largest id.
    """
    texts = documents.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    ).withColumn("row", F.xxhash64("text"))
    lines = (
        texts.select("id", "row", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
        .select("id", "row", "place", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= min_chars)
        .select(
            "id",
            "row",
            "place",
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(1), "key").alias("h2"),
        )
    )
    # Written out, so that the join below has plain shuffles under it and a hot line can be split.
    common = cut_lineage(
        lines.groupBy("h1", "h2", "id")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("one").alias("n"), F.max("id").alias("last"))
        .where(F.col("n") >= min_documents)
        .select("h1", "h2", "last")
    )
    places = (
        lines.join(common, ["h1", "h2"])
        .where(~F.col("id").eqNullSafe(F.col("last")))
        .groupBy(F.col("id").alias("did"), F.col("row").alias("drow"))
        .agg(F.collect_set("place").alias("places"))
    )
    split = F.split("text", "\n", -1)
    joined = texts.join(
        places, F.col("id").eqNullSafe(F.col("did")) & (F.col("row") == F.col("drow")), "left"
    ).select("id", "text", split.alias("lines"), "places")
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("places"))
    rest = F.transform(kept, lambda at: F.get(F.col("lines"), at))
    return joined.select(
        F.col("id").alias(id_column),
        F.when(F.col("places").isNull(), F.col("text"))
        .otherwise(F.array_join(rest, "\n"))
        .alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_dropped"),
    )
