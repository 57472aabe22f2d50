"""Benchmark decontamination by latent semantic retrieval.

1. *Statistics.* One pass counts in how many passages (64 words) each word occurs, over all
   documents. The vocabulary is the words of the items and the most frequent of all.
2. *Latent space.* Randomised SVD (Halko et al., 2011) of the TF-IDF rows of all passages and of the
   benchmark: the start is the range of the benchmark rows, a second pass multiplies every row with
   it, and the space is that of the Nystrom approximation. Spark adds up the partial sums. All
   passages together weigh like ``_CORPUS`` items of weight one; the benchmark rows weigh more, so
   their words shape the space.
3. *Candidates.* Whole documents are cut into blocks of eight words, and runs of blocks as long as the
   item are compared with it by cosine. A match shares at least ``least_loose`` of the item's places,
   so it holds at least ``k`` of its ``(1 - least_loose) * words + k`` rarest ones: runs without so
   many are left out before any vector is made, which loses nothing.
4. *Checks.* The longest common subsequence of words of item and run must hold ``least_common`` of
   the item; a weaker match (``least_loose``) counts as a paraphrase if the answer, the last
   sentence of the item, is also there.

The benchmark goes out in blocks of bounded size (``block_words``, and distinct words of at most half
the ``features``), each searched against all documents. Every word of an item is in its block's
space; the words of the corpus share what is left of it. Nothing of the corpus is dropped before the
cosine test; ``least_cosine=None`` leaves that test out too, and the search is exact.

Rows and edge cases: null and empty texts match nothing. Items of fewer than ``least_words`` words
are no evidence and match nothing. Rows that repeat an id are searched each, and the best match per
(document, item) is returned once; a null id is an id like others, of documents and of items.
Repeated items all match. ``drop_leaks`` judges each row by its own text, also where ids repeat or
are null. Other columns are ignored, whatever their names. An empty benchmark or corpus gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.arrays import PUNCTUATED, Words, mix, runs, words_of
from tarnlake.session import cut_lineage

PASSAGE = 64
BLOCK = 8
_SLOT_BITS = 17
#: Passages of weight one that all passages of a corpus weigh as much as.
_CORPUS = 4_096
#: Runs or words whose vectors are made in one step, and passages: they stay in the processor cache.
_STEP = 2048
_PASSAGES = 32
#: Distinct words that a task counts before it hands the counts on.
_COUNTED = 1 << 19
#: Stands behind the sorted words of a space.
_NO_WORD = (1 << 64) - 1
#: Bytes of the texts of one array step: its words and vectors stay in the processor cache.
_SEARCH_BYTES = 1 << 18
_FOUND = (
    "doc_id long, item_id long, cosine double, common long, item_words long, answer boolean, "
    "start_word long"
)

#: With the hash of the row that leaks.
_FOUND_ROWS = f"{_FOUND}, key long"


@dataclass(frozen=True)
class Item:
    item_id: int | None
    words: np.ndarray
    answer: np.ndarray

    @property
    def blocks(self) -> int:
        """Blocks that a run must have to hold the item wherever it begins."""
        return -(-(len(self.words) - 1) // BLOCK) + 1


def _hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return words_of(data, np.array([0, len(data)]), True, PUNCTUATED).hashes()


def _item(item_id: int, text: str) -> Item:
    """The answer is the last sentence with three words, or else the last quarter."""
    words = _hashes(text)
    tails = [_hashes(s) for s in re.split(r"(?<=[.!?])\s+", text.strip())]
    tails = [t for t in tails[1:] if len(t) >= 3]
    return Item(item_id, words, tails[-1] if tails else words[-max(3, len(words) // 4) :])


def _passages(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First and last words of the passages of all rows, one after the other."""
    starts = np.concatenate(
        [np.arange(a, b, PASSAGE) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        or [np.empty(0, np.int64)]
    ).astype(np.int64)
    row = np.searchsorted(words.first, starts, "right") - 1
    return starts, np.minimum(starts + PASSAGE, words.first[row + 1])


def _added(words: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words of several counts and their sums."""
    every, where = np.unique(np.concatenate(words), return_inverse=True)
    sums = np.zeros(len(every), np.int64)
    np.add.at(sums, where, np.concatenate(counts))
    return every, sums


def _passage_counts(hashes: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words, sorted, and in how many parts each occurs; ``part`` is that of each word."""

    def changes(values: np.ndarray) -> np.ndarray:
        return np.concatenate(([True], values[1:] != values[:-1]))

    order = np.argsort(hashes)
    hashes = hashes[order]
    first = changes(hashes)
    pairs = np.sort((np.cumsum(first) - 1) * (int(part[-1]) + 1) + part[order])
    heads = np.flatnonzero(first)
    return hashes[heads], np.add.reduceat(changes(pairs).astype(np.int64), heads)


def _statistics(texts: DataFrame, sample: int | None) -> tuple[DataFrame, int, DataFrame]:
    """Passages per word (``w, n``), number of passages, and the rows that the space is made from: all
    texts, or the ``sample`` passages with the smallest random keys."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_held: list[np.ndarray] = []
        counts_held: list[np.ndarray] = []
        held = total = 0

        def told(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(keys), 1 << 16):
                some = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[some].view(np.int64)), pa.array(counts[some])], names=["w", "n"]
                )

        for _, data, offsets in runs(batches, limit=_SEARCH_BYTES):
            words = words_of(data, offsets, True, PUNCTUATED)
            starts, ends = _passages(words)
            if not len(starts):
                continue
            total += len(starts)
            every, counts = _passage_counts(words.hashes(), np.repeat(np.arange(len(starts)), ends - starts))
            words_held.append(every)
            counts_held.append(counts)
            held += len(every)
            if held > 2 * _COUNTED:
                keys, counts = _added(words_held, counts_held)
                words_held, counts_held, held = [keys], [counts], len(keys)
                if held > _COUNTED:
                    yield from told(keys, counts)
                    words_held, counts_held, held = [], [], 0
        if words_held:
            yield from told(*_added(words_held, counts_held))
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total])], names=["w", "n"])

    counts = texts.select("text").mapInArrow(scan, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    counts = cut_lineage(counts, "counts")
    total = counts.where("w is null").select("n").first()
    rows = texts.select("text") if sample is None else _drawn(texts, sample)
    return counts.where("w is not null"), total[0] if total else 0, rows


def _drawn(texts: DataFrame, sample: int) -> DataFrame:
    """The words (``body``) of the passages with the smallest random keys."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in runs(batches):
            words = words_of(data, offsets, True, PUNCTUATED)
            hashes = words.hashes()
            starts, ends = _passages(words)
            row = np.searchsorted(words.first, starts, "right") - 1
            ids = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            keys = mix(ids[row] + (starts - words.first[row]).astype(np.uint64)) >> np.uint64(1)
            bodies = [hashes[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(bodies, pa.binary())], names=["key", "body"]
            )

    passages = texts.select("key", "text").mapInArrow(scan, "key long, body binary")
    return cut_lineage(passages.orderBy("key", "body").limit(sample).select("body"))


@dataclass(frozen=True)
class _Space:
    """Word table of the latent space: first word of a slot, the sorted hashes, ``idf * V``, and the
    idf, which only says what to look up first."""

    slots: np.ndarray
    known: np.ndarray
    table: np.ndarray
    idf: np.ndarray | None = None

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """Table row of each word; the last row is zero and stands for unknown words."""
        at = self.slots[(hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)].astype(np.int64)
        behind = np.flatnonzero(self.known[at] < hashes)
        while len(behind):
            at[behind] += 1
            behind = behind[self.known[at[behind]] < hashes[behind]]
        return np.where(self.known[at] == hashes, at, len(self.known) - 1)


def _slots(vocabulary: np.ndarray) -> np.ndarray:
    """The first word of each slot in the sorted vocabulary; its size where there is none."""
    places = (vocabulary >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
    slots = np.full(1 << _SLOT_BITS, len(vocabulary), np.int32)
    slots[places[::-1]] = np.arange(len(vocabulary))[::-1]
    return slots


def _vocabulary(items: list[Item], counts: DataFrame, features: int) -> tuple[np.ndarray, np.ndarray]:
    """All words of the items, and up to ``features`` with the most frequent of all; sorted, and in how
    many passages each occurs."""
    own = np.unique(np.concatenate([i.words for i in items]))
    asked = counts.sparkSession.createDataFrame([(w,) for w in own.view(np.int64).tolist()], "w long")
    seen = {r.w: r.n for r in counts.join(F.broadcast(asked), "w").collect()}
    least = max(0, features - len(own))
    rest = counts.join(F.broadcast(asked), "w", "left_anti").orderBy(F.desc("n"), "w").limit(least).collect()
    seen |= {r.w: r.n for r in rest}
    more = np.array([r.w for r in rest], np.int64).view(np.uint64)
    vocabulary = np.sort(np.concatenate([own, more]))
    return vocabulary, np.array([seen.get(w, 0) for w in vocabulary.view(np.int64).tolist()], np.int64)


def _blocks(items: list[Item], features: int) -> Iterator[list[Item]]:
    """Runs of items whose distinct words fill at most half the space; a larger item is a run alone."""
    block: list[Item] = []
    held: set[int] = set()
    for item in items:
        own = set(item.words.tolist())
        if block and len(held | own) > features // 2:
            yield block
            block, held = [], set()
        block.append(item)
        held |= own
    if block:
        yield block


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Word hashes of runs of texts, or of rows of hashes, and the ends of their passages."""
    for batch in batches:
        if "text" in batch.schema.names:
            for _, data, offsets in runs([batch], limit=_SEARCH_BYTES):
                words = words_of(data, offsets, True, PUNCTUATED)
                yield words.hashes(), *_passages(words)
            continue
        bodies = [np.frombuffer(b, np.uint64) for b in batch["body"].to_pylist()]
        ends = np.cumsum([len(b) for b in bodies])
        yield np.concatenate(bodies), ends - [len(b) for b in bodies], ends


def _multiply(
    index: _Space, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, weight: float,
    q: np.ndarray, sums: np.ndarray,
) -> None:
    """Add a (a Q) of every passage to the sums, a being its weighted TF-IDF row."""
    part = np.repeat(np.arange(len(starts)), ends - starts)
    width = len(index.idf)
    keys, n = np.unique(part * width + index.rows(hashes), return_counts=True)
    part, row = keys // width, keys % width
    a = n * index.idf[row]
    some = a > 0
    part, row, a = part[some], row[some], a[some]
    if not len(a):
        return
    first = np.flatnonzero(np.diff(part, prepend=-1))
    sizes = np.diff(first, append=len(a))
    a = (a * np.repeat(weight / np.sqrt(np.add.reduceat(a * a, first)), sizes)).astype(np.float32)
    products = np.empty((len(first), q.shape[1]), np.float32)
    stops = np.append(first, len(a)).tolist()
    for at in range(0, len(first), _PASSAGES):
        own = stops[at : at + _PASSAGES + 1]
        vectors = q.take(row[own[0] : own[-1]], axis=0)
        for k, (low, high) in enumerate(zip(own[:-1], own[1:], strict=True), at):
            products[k] = a[low:high] @ vectors[low - own[0] : high - own[0]]
    keys = np.sort(row * len(a) + np.arange(len(a)))
    row, order = keys // len(a), keys % len(a)
    passage, a = np.repeat(np.arange(len(first)), sizes)[order], a[order]
    for at in range(0, len(a), _STEP):
        some = slice(at, at + _STEP)
        heads = np.flatnonzero(np.diff(row[some], prepend=-1))
        shares = products.take(passage[some], axis=0)
        shares *= a[some, None]
        sums[row[some][heads]] += np.add.reduceat(shares, heads, axis=0)


def _space(
    items: list[Item],
    corpus: DataFrame,
    counts: DataFrame,
    total: int,
    rank: int,
    features: int,
    item_weight: float,
    part_rows: int,
    seed: int,
) -> _Space:
    """Randomised SVD of the items and all rows of the corpus, multiplied in Spark tasks."""
    vocabulary, df = _vocabulary(items, counts, features)
    slots = _slots(vocabulary)
    known = np.append(vocabulary, np.uint64(_NO_WORD))
    idf = np.append(np.maximum(np.log((1 + total) / (1 + df)), 0.0), 0.0).astype(np.float32)
    index = _Space(slots, known, idf[:, None], idf)
    width = len(vocabulary) + 1
    spark = corpus.sparkSession
    own = spark.createDataFrame([(i.words.tobytes(),) for i in items], "body binary")
    own = own.coalesce(1 + len(items) // part_rows)
    rows = total
    if "body" in corpus.columns:
        rows = corpus.count()
        corpus = corpus.repartition(1 + rows // part_rows)
    words = spark.sparkContext.broadcast(index)

    def multiply(frame: DataFrame, weight: float, q: np.ndarray) -> np.ndarray:
        """The sum over all rows a of a (a Q)."""
        shared = spark.sparkContext.broadcast(q)

        def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, q = words.value, shared.value
            sums = np.zeros(q.shape, np.float32)
            for hashes, starts, ends in _read(batches):
                _multiply(index, hashes, starts, ends, weight, q, sums)
            yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

        parts = frame.mapInArrow(partial, "sums binary").rdd.map(lambda r: np.frombuffer(r[0], np.float32))
        # The last sum is a task's too, so that one matrix reaches the driver and not one a partition.
        few = max(1, round(parts.getNumPartitions() ** 0.5))
        summed = parts.mapPartitionsWithIndex(lambda i, rows: ((i % few, row) for row in rows))
        whole = summed.reduceByKey(np.add, few).values().coalesce(1).mapPartitions(lambda rows: [reduce(np.add, rows)])
        total = whole.collect()[0].reshape(q.shape)
        shared.destroy()
        return total

    count = min(rank + 8, max(1, len(vocabulary)))
    random = np.random.default_rng(seed)
    start = np.empty((width, count), np.float32)
    for some in _rows_of(start):
        start[some] = random.standard_normal(start[some].shape)
    near = multiply(own, item_weight, start).copy()
    # Directions that the items leave open are random ones.
    near += np.float32(1e-3 * np.sqrt(np.trace(_inner(near, near)) / np.trace(_inner(start, start)))) * start
    del start
    basis = _times_small(near, _whitened(_inner(near, near))[0])
    del near
    share = float(np.sqrt(min(1.0, _CORPUS / max(1, rows))))
    product = multiply(own, item_weight, basis) + multiply(corpus, share, basis)
    words.destroy()
    inner = _inner(basis, product)
    del basis
    white, r = _whitened(_inner(product, product))
    values, vectors = np.linalg.eigh(r @ np.linalg.pinv((inner + inner.T) / 2, rcond=1e-6, hermitian=True) @ r.T)
    table = _times_small(product, white @ vectors[:, np.argsort(-values)[:rank]])
    table *= idf[:, None]
    table[-1] = 0.0
    return _Space(slots, known, table, idf)


def _rows_of(matrix: np.ndarray) -> Iterator[slice]:
    """Runs of rows: the driver holds its tall matrices in single precision and works on a run in double."""
    return (slice(at, at + _STEP) for at in range(0, len(matrix), _STEP))


def _inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The products of all columns of two tall matrices."""
    total = np.zeros((a.shape[1], b.shape[1]))
    for some in _rows_of(a):
        total += a[some].astype(np.float64).T @ b[some].astype(np.float64)
    return total


def _times_small(tall: np.ndarray, small: np.ndarray) -> np.ndarray:
    out = np.empty((len(tall), small.shape[1]), np.float32)
    for some in _rows_of(tall):
        out[some] = tall[some].astype(np.float64) @ small
    return out


def _whitened(inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a matrix A with these inner products, W with orthonormal columns A W, and R with A = A W R.

    Columns of A W are zero where A has no more directions than single precision can tell.
    """
    values, vectors = np.linalg.eigh(inner)
    sizes = np.sqrt(np.maximum(values, 0.0))
    sizes[sizes <= 1e-7 * sizes.max()] = 0.0
    inverse = np.divide(1.0, sizes, out=np.zeros_like(sizes), where=sizes > 0)
    return vectors * inverse, sizes[:, None] * vectors.T


class Common:
    """Longest common subsequences of one word sequence with others, by bit vectors (Hyyro, 2004)."""

    def __init__(self, item: np.ndarray) -> None:
        self.size = len(item)
        self.masks: dict[int, int] = {}
        for i, word in enumerate(item.tolist()):
            self.masks[word] = self.masks.get(word, 0) | (1 << i)

    def known(self, run: list[int]) -> list[int]:
        """The places of those words of the run that the item has."""
        masks = self.masks
        return [masks[word] for word in run if word in masks]

    def length(self, known: list[int]) -> int:
        full = (1 << self.size) - 1
        v = full
        for m in known:
            u = v & m
            v = ((v + u) | (v - u)) & full
        return self.size - v.bit_count()


def common_words(item: np.ndarray, run: np.ndarray) -> int:
    """Length of the longest common subsequence of two word sequences."""
    common = Common(item)
    return common.length(common.known(run.tolist()))


def _block_vectors(words: Words, rows: np.ndarray, table: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Vectors of blocks of eight words from ``start``, cut at ``end``."""
    last = len(rows) - 1
    vectors = np.zeros((len(start), table.shape[1]), np.float32)
    for step in range(BLOCK):
        at = start + step
        picked = np.where(at < end, rows[np.minimum(at, last)], len(table) - 1)
        vectors += table.take(picked, axis=0)
    return vectors


#: Rarest places of an item that a run must hold beyond what a match may lack.
_HITS = 4


class _Items:
    """The items of a space: their units, and by word the items that the word is rare in."""

    def __init__(self, items: list[Item], space: _Space, least_loose: float) -> None:
        self.items = items
        self.blocks = np.array([i.blocks for i in items])
        self.places = [space.rows(i.words) for i in items]
        q = np.array([space.table[at].sum(axis=0) for at in self.places])
        self.units = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-9)
        self.sought = [(Common(i.words), Common(i.answer)) for i in items]
        self.least = np.array([int(np.ceil(least_loose * len(i.words))) for i in items])
        self.hits = np.minimum(np.maximum(self.least, 1), _HITS)
        pairs = []
        rarity = np.zeros(len(space.known)) if space.idf is None else space.idf
        for k, at in enumerate(self.places):
            rare = np.argsort(-rarity[at], kind="stable")
            rare = rare[: len(at) - self.least[k] + self.hits[k]]
            pairs.append(np.unique(at[rare]) * len(items) + k)
        pairs = np.sort(np.concatenate(pairs))
        self.by_word = pairs % len(items)
        self.first = np.searchsorted(pairs // len(items), np.arange(len(space.known) + 1))

    def candidates(self, rows: np.ndarray, block: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, first block) of all runs that hold enough of an item's rare words.

        ``rows`` and ``block`` tell table row and block of each word, ``doc`` the row of each block.
        """
        degree = self.first[rows + 1] - self.first[rows]
        at = np.flatnonzero(degree)
        degree = degree[at]
        ends = np.cumsum(degree)
        offset = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - degree, degree)
        item = self.by_word[np.repeat(self.first[rows[at]], degree) + offset]
        n_blocks = len(doc) + 1
        keys = np.sort(item * n_blocks + np.repeat(block[at], degree))
        item, place = keys // n_blocks, keys % n_blocks
        found = []
        for k in np.unique(self.hits).tolist():
            low, high = np.arange(len(keys) - k + 1), np.arange(k - 1, len(keys))
            low, high = (low, high) if len(keys) >= k else (low[:0], high[:0])
            span = self.blocks[item[low]]
            fits = (item[low] == item[high]) & (self.hits[item[low]] == k)
            fits &= (place[high] - place[low] <= span + 1) & (doc[place[low]] == doc[place[high]])
            low, high, span = low[fits], high[fits], span[fits]
            start, stop = np.maximum(place[high] - span, 0), np.minimum(place[low] + 1, len(doc) - 1)
            count = stop - start + 1
            steps = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            run = np.repeat(start, count) + steps
            same = doc[run] == np.repeat(doc[place[low]], count)
            found.append((np.repeat(item[low], count) * n_blocks + run)[same])
        pairs = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        return pairs // n_blocks, pairs % n_blocks


def _search(
    texts: DataFrame,
    items: list[Item],
    space: _Space,
    least_cosine: float | None,
    least_common: float,
    least_loose: float,
    least_answer: float,
) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast((space, items))

    def check(whole: Common, answer: Common, run: list[int]) -> tuple[int, bool] | None:
        known = whole.known(run)
        least = least_loose * whole.size
        if len(known) < least or (common := whole.length(known)) < least:
            return None
        told = answer.length(answer.known(run)) >= least_answer * answer.size
        return (common, told) if told or common >= least_common * whole.size else None

    def cosines(
        words: Words, rows: np.ndarray, space: _Space, held: _Items, item: np.ndarray, run: np.ndarray,
        doc: np.ndarray, start: np.ndarray,
    ) -> np.ndarray:
        """Cosine of each candidate, its run cut at the end of its row."""
        out = np.empty(len(item), np.float32)
        for at in range(0, len(item), _STEP):
            k, b = item[at : at + _STEP], run[at : at + _STEP]
            size = np.minimum(held.blocks[k], np.searchsorted(doc, doc[b], "right") - b)
            ends = np.cumsum(size)
            part = np.repeat(b - (ends - size), size) + np.arange(ends[-1])
            used, back = np.unique(part, return_inverse=True)
            vectors = _block_vectors(words, rows, space.table, start[used], words.first[doc[used] + 1])
            total = np.add.reduceat(vectors[back], ends - size, axis=0)
            norm = np.maximum(np.sqrt(np.einsum("ij,ij->i", total, total)), 1e-9)
            out[at : at + _STEP] = np.einsum("ij,ij->i", total, held.units[k]) / norm
        return out

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, items = shared.value
        held = _Items(items, space, least_loose)
        mark = np.zeros(len(space.table), bool)
        for batch, data, offsets in runs(batches, limit=_SEARCH_BYTES):
            words = words_of(data, offsets, True, PUNCTUATED)
            if not len(words.starts):
                continue
            hashes = words.hashes()
            rows = space.rows(hashes)
            sizes = np.diff(words.first)
            counts = -(-sizes // BLOCK)
            doc = np.repeat(np.arange(len(sizes)), counts)
            first_block = np.cumsum(counts) - counts
            start = words.first[doc] + (np.arange(len(doc)) - first_block[doc]) * BLOCK
            row = words.rows()
            block = first_block[row] + (np.arange(len(row)) - words.first[row]) // BLOCK
            item, run = held.candidates(rows, block, doc)
            if not len(item):
                continue
            cosine = np.ones(len(item), np.float32)
            if least_cosine is not None:
                cosine = cosines(words, rows, space, held, item, run, doc, start)
                near = cosine >= least_cosine
                item, run, cosine = item[near], run[near], cosine[near]
            low = np.maximum(words.first[doc[run]], start[run] - BLOCK)
            high = np.minimum(words.first[doc[run] + 1], start[run] + (held.blocks[item] + 1) * BLOCK)
            shared_words = np.zeros(len(rows) + 1, np.int32)
            best: dict[tuple[int, int], tuple] = {}
            edges = np.flatnonzero(np.diff(item, prepend=-1))
            for at, end in zip(edges, np.append(edges, len(item))[1:], strict=True):
                k = int(item[at])
                # No common subsequence is longer than the words of the run that the item has.
                mark[held.places[k]] = True
                np.cumsum(mark.take(rows), out=shared_words[1:])
                mark[held.places[k]] = False
                enough = shared_words[high[at:end]] - shared_words[low[at:end]] >= held.least[k]
                for c in (at + np.flatnonzero(enough)).tolist():
                    lo = int(low[c])
                    found = check(*held.sought[k], hashes[lo : int(high[c])].tolist())
                    if found:
                        key = (int(doc[run[c]]), k)
                        value = (found[0], found[1], float(cosine[c]), lo)
                        if key not in best or value[:3] > best[key][:3]:
                            best[key] = value
            if best:
                leaks = list(best.items())
                taken = pa.array([k[0] for k, _ in leaks])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(taken),
                        pa.array([items[k[1]].item_id for k, _ in leaks], pa.int64()),
                        pa.array([v[2] for _, v in leaks], pa.float64()),
                        pa.array([v[0] for _, v in leaks], pa.int64()),
                        pa.array([len(items[k[1]].words) for k, _ in leaks], pa.int64()),
                        pa.array([v[1] for _, v in leaks], pa.bool_()),
                        pa.array([v[3] - int(words.first[k[0]]) for k, v in leaks], pa.int64()),
                        batch.column("key").take(taken),
                    ],
                    names=[c.split()[0] for c in _FOUND_ROWS.split(", ")],
                )

    return texts.select("id", "text", "key").mapInArrow(search, _FOUND_ROWS)


def _leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    rank: int = 64,
    features: int = 32_768,
    sample: int | None = None,
    item_weight: float = 4.0,
    least_cosine: float | None = 0.5,
    least_common: float = 0.7,
    least_loose: float = 0.5,
    least_answer: float = 0.8,
    least_words: int = 5,
    block_words: int = 200_000,
    part_rows: int = 1_536,
    seed: int = 7,
) -> DataFrame:
    """The matches of every row, named by id and ``row_key``."""
    texts = documents.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(text_column).cast("string").alias("text"),
        row_key(F.col(id_column), F.col(text_column)).alias("key"),
    ).where(F.col("text").isNotNull())
    asked = cut_lineage(
        benchmark.select(
            F.col(item_column).cast("long").alias("item_id"),
            F.col(item_text_column).cast("string").alias("text"),
        ).where(F.col("text").isNotNull())
    )
    chars = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    counts, total, corpus = _statistics(texts, sample)
    found = documents.sparkSession.createDataFrame([], _FOUND_ROWS)
    blocks = max(1, -(-chars // (6 * block_words)))
    for block in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).distinct()
        items = [_item(r.item_id, r.text) for r in part.orderBy("item_id", "text").collect()]
        items = [i for i in items if len(i.words) >= least_words]
        for some in _blocks(items, features) if total else ():
            space = _space(some, corpus, counts, total, rank, features, item_weight, part_rows, seed)
            rows = _search(texts, some, space, least_cosine, least_common, least_loose, least_answer)
            found = found.unionByName(rows)
    return found


def row_key(key: Column, text: Column) -> Column:
    """A hash that tells rows with one id, or none, apart by their texts."""
    return F.xxhash64(key.cast("long"), text.cast("string"))


def find_leaks(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, item_id, cosine, common, item_words, answer, start_word``, one row per leak.

    ``common`` is the longest common subsequence in words, ``answer`` whether the item's answer was
    found too, ``start_word`` where the compared run begins in the document. The options are those
    of the search: columns, ``rank``, ``features``, ``sample``, thresholds and sizes.
    """
    order = F.struct("common", "answer", "cosine", "item_words", "start_word")
    found = _leaks(documents, benchmark, **options)
    best = found.groupBy("doc_id", "item_id").agg(F.max(order).alias("best"))
    return best.select("doc_id", "item_id", "best.*").select(
        *[c.split()[0] for c in _FOUND.split(", ")]
    )


def drop_leaks(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows without a leak, with all their columns; each row is judged by its own text."""
    names = (options.get("id_column", "doc_id"), options.get("text_column", "text"))
    leaked = cut_lineage(
        _leaks(documents, benchmark, **options).select(F.col("key").alias("_leak")).distinct()
    )
    own = row_key(*[F.col(f"d.`{n}`") for n in names])
    return documents.alias("d").join(leaked.alias("x"), own == F.col("x._leak"), "left_anti")
