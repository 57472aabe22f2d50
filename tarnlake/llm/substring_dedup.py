"""Removal of passages that an earlier document has, by relative Lempel-Ziv factors.

Every document is factored against all documents with a smaller id, which together are the
reference. The reference index holds sync points: word k-grams whose hash is the least in some run
of neighbouring k-grams (winnowing, Schleimer et al., 2003). Any passage of ``window`` words has at
least one of them, at the same place in every copy.

1. *Index.* Sync points of all documents with their places; those that only one document has are
   dropped.
2. *Reference blocks.* The block around a sync point is the union of all windows that contain it. A
   block that an earlier document has word for word is copied from the first place that has it.
3. *Factors.* The copied blocks of a document, in order, extend the factor before them to the right
   as long as they go on in its source at the same distance; else a new factor begins.
4. *Factor boundaries.* Where the same sync point has different blocks, copies begin or end inside
   the block. Only there single windows are looked up, each against the first place that has it,
   and extend the factors to where the copies really end.
5. Factors of at least ``window`` words are removed. Windows are judged on the input.

A factor is a source document, a first word there, and a length. Its words stand in an earlier document,
and every window that an earlier document has lies inside a factor, so the result is exact (64 and
128-bit hashes). Shuffled are sync points (about 2 in 27 words), windows at boundaries, and the text
once.

Rows and edge cases: null text has no words; texts shorter than the window stay whole. A row with a
null id is neither reference nor changed. Rows that repeat an id count as the same document, so
they don't remove each other; each is returned. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.arrays import Windows, Words, runs, signed, words_of
from tarnlake.session import cut_lineage

_SECOND_BASE = 0xC2B2AE3D27D4EB4F
#: Words of a document that a place can name.
_PLACES = 1 << 31
_RESULT = (
    "id long, text string, n_words long, n_removed long, "
    "spans array<struct<start:int,end:int>>, factors array<struct<start:int,source_id:long,source_word:int,length:int>>"
)
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_FACTOR = pa.struct(
    [("start", pa.int32()), ("source_id", pa.int64()), ("source_word", pa.int32()), ("length", pa.int32())]
)


class _Blocks:
    """Sync points of a run of rows: hash of the k-gram, row, and block [lo, hi) with its hash."""

    def __init__(self, words: Words, hashes: Windows, window: int) -> None:
        gram = window // 2 + 1
        width = window - gram + 1
        at = words.windows(window)
        self.row = self.lo = self.hi = np.empty(0, np.int64)
        self.point = self.block = np.empty(0, np.uint64)
        if not len(at):
            return
        starts = np.arange(len(words.starts) - gram + 1)
        grams = hashes.hashes(starts, starts + gram)
        least = np.lib.stride_tricks.sliding_window_view(grams, width)[at].argmin(axis=1) + at
        points = np.unique(least)
        self.row = np.searchsorted(words.first, points, "right") - 1
        self.lo = np.maximum(words.first[self.row], points + gram - window)
        self.hi = np.minimum(words.first[self.row + 1], points + window)
        self.point = grams[points]
        self.block = hashes.hashes(self.lo, self.hi)


def _read(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[Words, Windows, _Blocks]:
    words = words_of(data, offsets)
    hashes = Windows(words.hashes())
    return words, hashes, _Blocks(words, hashes, window)


def _sync_points(texts: DataFrame, window: int) -> DataFrame:
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in runs(batches):
            words, _, found = _read(data, offsets, window)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(found.point)),
                    pa.array(signed(found.block)),
                    batch.column("id").take(pa.array(found.row)),
                    pa.array((found.lo - words.first[found.row]).astype(np.int32)),
                ],
                names=["point", "block", "id", "place"],
            )

    schema = "point long, block long, id long, place int"
    return texts.where(F.col("id").isNotNull()).mapInArrow(find, schema)


def _first_place() -> Column:
    """The smallest (id, place) as one number, which Spark aggregates without a sort."""
    return F.min(F.col("id").cast("decimal(20,0)") * _PLACES + F.col("place")).cast("decimal(38,0)")


def _source(first: str) -> list[Column]:
    """Id and place from such a number."""
    at = F.col(first)
    key = F.floor(at / F.lit(_PLACES)).cast("long")
    place = (at - key.cast("decimal(20,0)") * _PLACES).cast("int")
    return [key.alias("source_id"), place.alias("source_word")]


def _marks(texts: DataFrame, window: int) -> DataFrame:
    """Per id the blocks that an earlier document has, and those whose windows must be looked up."""
    points = _sync_points(texts, window)
    # Written out, so that the join has plain shuffles under it and a hot point can be split.
    several = cut_lineage(
        points.groupBy("point")
        .agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
        .where(F.col("lo") < F.col("hi"))
        .select("point")
    )
    shared = cut_lineage(points.join(several, "point", "left_semi"))
    blocks = shared.groupBy("point", "block").agg(_first_place().alias("first"))
    blocks = blocks.select("point", "block", *_source("first"))
    kinds = blocks.groupBy("point").agg(F.count(F.lit(1)).alias("kinds"))
    judged = (
        shared.select("point", "block", "id")
        .distinct()
        .join(blocks.join(kinds, "point"), ["point", "block"])
        .withColumn("copied", F.col("id") > F.col("source_id"))
        .where(F.col("copied") | (F.col("kinds") > 1))
    )
    part = F.struct("block", "source_id", "source_word")
    return cut_lineage(
        judged.groupBy("id").agg(
            F.collect_list(F.when(F.col("copied"), part)).alias("copied"),
            F.collect_list(F.when(~F.col("copied"), F.col("block"))).alias("unsure"),
        )
    )


def _places(lo: np.ndarray, hi: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places the ranges [lo, hi) cover."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, lo, 1)
    np.add.at(steps, hi, -1)
    return np.cumsum(steps[:-1]) > 0


def _listed(column: pa.ListArray, row: int) -> np.ndarray:
    item = column[row]
    if not item.is_valid:
        return np.empty(0, np.uint64)
    return item.values.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)


def _parts(column: pa.ListArray, row: int, hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Which hashes a row's list of copies has, with id and first word of each one's source."""
    item = column[row]
    none = np.empty(0, np.int64)
    if not item.is_valid or not len(item.values):
        return none, none, none
    name, *source = (item.values.field(i).to_numpy(zero_copy_only=False) for i in range(3))
    name = name.astype(np.int64).view(np.uint64)
    order = np.argsort(name, kind="stable")
    at = np.minimum(np.searchsorted(name[order], hashes), len(name) - 1)
    hit = np.flatnonzero(name[order][at] == hashes)
    return hit, *(x[order][at[hit]].astype(np.int64) for x in source)


def _factors(start: np.ndarray, end: np.ndarray, source: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Rows ``start, source, word, length``: copies in order, joined while one goes on in its source.

    A copy that ends inside the factor before it is left out; one that begins there goes on from
    where that factor ends, so that factors do not overlap.
    """
    order = np.lexsort((word, source, -end, start))
    out: list[list[int]] = []
    for s, e, i, w in zip(*(x[order].tolist() for x in (start, end, source, word)), strict=True):
        last = out[-1] if out else None
        if last is not None and e <= last[0] + last[3]:
            continue
        if last is not None and s <= last[0] + last[3] and i == last[1] and w - s == last[2] - last[0]:
            last[3] = e - last[0]
            continue
        cut = max(0, last[0] + last[3] - s) if last is not None else 0
        out.append([s + cut, i, w + cut, e - s - cut])
    return np.array(out, np.int64).reshape(-1, 4)


def _open_windows(batch: pa.RecordBatch, words: Words, found: _Blocks, window: int) -> np.ndarray:
    """Starts of all windows in blocks that must be looked up."""
    column, chosen = batch.column("unsure"), np.zeros(len(found.row), bool)
    bounds = np.searchsorted(found.row, np.arange(batch.num_rows + 1))
    for row in range(batch.num_rows):
        asked = _listed(column, row)
        if len(asked):
            part = slice(bounds[row], bounds[row + 1])
            chosen[part] = np.isin(found.block[part], asked)
    if not chosen.any():
        return np.empty(0, np.int64)
    lo, hi = found.lo[chosen], found.hi[chosen] - window + 1
    return np.flatnonzero(_places(lo, hi, len(words.starts)))


def _boundary_windows(marked: DataFrame, window: int) -> DataFrame:
    """Hashes of the windows to look up, with document and word that they start at."""

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in runs(batches):
            words, hashes, found = _read(data, offsets, window)
            at = _open_windows(batch, words, found, window)
            row = np.searchsorted(words.first, at, "right") - 1
            second = Windows(words.hashes(), _SECOND_BASE) if len(at) else hashes
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(hashes.hashes(at, at + window))),
                    pa.array(signed(second.hashes(at, at + window))),
                    batch.column("id").take(pa.array(row)),
                    pa.array((at - words.first[row]).astype(np.int32)),
                ],
                names=["w1", "w2", "id", "place"],
            )

    return marked.mapInArrow(look, "w1 long, w2 long, id long, place int")


def _cut(marked: DataFrame, window: int) -> DataFrame:
    """Words outside the factors, joined by one space, with the removed spans and the factors."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in runs(batches):
            words, hashes, found = _read(data, offsets, window)
            n = len(words.starts)
            gone = np.zeros(n, bool)
            copied, repeated = batch.column("copied"), batch.column("repeated")
            bounds = np.searchsorted(found.row, np.arange(batch.num_rows + 1))
            listed, ends_of = [], [0]
            for row in range(batch.num_rows):
                a, b = words.first[row], words.first[row + 1]
                part = slice(bounds[row], bounds[row + 1])
                hit, source, word = _parts(copied, row, found.block[part])
                pieces = [(found.lo[part][hit] - a, found.hi[part][hit] - a, source, word)]
                if repeated[row].is_valid:
                    at = np.arange(a, b - window + 1)
                    hit, source, word = _parts(repeated, row, hashes.hashes(at, at + window))
                    pieces.append((hit, hit + window, source, word))
                made = _factors(*(np.concatenate(x) for x in zip(*pieces, strict=True)))
                gone[a:b] |= _places(made[:, 0], made[:, 0] + made[:, 3], b - a)
                listed.append(made)
                ends_of.append(ends_of[-1] + len(made))
            made = np.concatenate(listed) if listed else np.empty((0, 4), np.int64)
            factors = pa.StructArray.from_arrays(
                [pa.array(made[:, i].astype(f.type.to_pandas_dtype())) for i, f in enumerate(_FACTOR)],
                fields=list(_FACTOR),
            )
            kept = ~gone
            # A kept word takes the blank after it along, unless it is the last one of its row.
            rows = words.rows()
            left = np.flatnonzero(kept)
            joined = left[:-1][rows[left[:-1]] == rows[left[1:]]]
            take = _places(words.starts[left], words.ends[left], len(data))
            take[words.ends[joined]] = True
            clean = data.copy()
            clean[words.ends[joined]] = 32
            sizes = np.add.reduceat(np.append(take, False), offsets[:-1]) if len(data) else 0
            sizes = np.where(np.diff(offsets) > 0, sizes, 0)
            places = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            body = clean[take]
            text = pa.StringArray.from_buffers(
                batch.num_rows, pa.py_buffer(places.tobytes()), pa.py_buffer(body.tobytes())
            )
            before = np.concatenate(([True], rows[1:] != rows[:-1])) if n else np.empty(0, bool)
            after = np.append(before[1:], True) if n else before
            starts = np.flatnonzero(gone & (before | ~np.roll(gone, 1)))
            ends = np.flatnonzero(gone & (after | ~np.roll(gone, -1)))
            base = words.first[rows[starts]] if len(starts) else starts
            spans = pa.StructArray.from_arrays(
                [
                    pa.array((starts - base).astype(np.int32)),
                    pa.array((ends + 1 - base).astype(np.int32)),
                ],
                fields=list(_SPAN),
            )
            cuts = np.searchsorted(starts, words.first).astype(np.int32)
            total = np.concatenate(([0], np.cumsum(gone)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    text,
                    pa.array(np.diff(words.first).astype(np.int64)),
                    pa.array((total[words.first[1:]] - total[words.first[:-1]]).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(cuts), spans),
                    pa.ListArray.from_arrays(pa.array(np.array(ends_of, np.int32)), factors),
                ],
                names=["id", "text", "n_words", "n_removed", "spans", "factors"],
            )

    return marked.select("id", "text", "copied", "repeated").mapInArrow(cut, _RESULT)


def drop_repeated_passages(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = 50,
) -> DataFrame:
    """``id_column, text, n_words, n_removed, spans, factors`` for every row of ``documents``.

    ``text`` holds the kept words joined by one space; ``spans`` the removed word ranges
    ``[start, end)`` of the input, the union of the ``factors``: ``start, source_id, source_word,
    length``, each copied word for word from an earlier document. Only the last part of a copy that
    changes its source may be a factor of fewer words than the window.
    """
    if window < 2:
        raise ValueError("window must be at least 2 words")
    texts = documents.select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text")
    )
    marks = _marks(texts, window)
    unsure = marks.where(F.size("unsure") > 0).select("id", "unsure")
    looked = _boundary_windows(texts.join(unsure, "id"), window)
    first = looked.groupBy("w1", "w2").agg(
        _first_place().alias("first"), F.min("id").alias("lo"), F.max("id").alias("hi")
    ).where(F.col("lo") < F.col("hi")).select("w1", "w2", *_source("first"))
    repeated = (
        looked.select("w1", "w2", "id")
        .distinct()
        .join(first, ["w1", "w2"])
        .where(F.col("id") > F.col("source_id"))
        .groupBy("id")
        .agg(F.collect_list(F.struct("w1", "source_id", "source_word")).alias("repeated"))
    )
    marked = texts.join(
        marks.select("id", "copied").join(repeated, "id", "full_outer"), "id", "left"
    )
    return _cut(marked, window).withColumnRenamed("id", id_column)
