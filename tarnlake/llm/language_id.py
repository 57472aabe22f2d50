"""Language identification: sparse multinomial regression on TF-IDF character n-grams.

*Features.* Letters in lower case, everything else one blank; all n-grams of one to three
characters, hashed. Term weights are ``log(1 + count) * idf``, scaled to length one per text. The
document frequencies cover every training text.

*Training.* Follow-the-regularised-leader with an elastic net (per coordinate; McMahan et al., 2013)
over a sample of at most ``per_label`` texts of each label, the ones with the smallest id hashes,
in hash order. Features of the sample are built on the executors; the driver holds the sample's
sparse vectors and the weights, whose sizes have these bounds.

*Calibration.* A fifth of the sample is not trained on; one temperature is fitted to it.

Prediction reads whole texts in Arrow batches with the weights as a broadcast of fixed size.

Rows and edge cases: null text and text without a letter is ``und`` with score 0. Null labels are
not learned. Ties go to the label first in code point order. Repeated rows are judged alike. Without
any label to learn from, every text is ``und``. All columns of the input are kept; columns named as
the added ones are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tarnlake.llm.arrays import mix, runs

UNKNOWN = "und"
_GRAMS = (1, 2, 3)


def _letter_table() -> np.ndarray:
    """Lower case of each letter of the basic plane, and blank for all else."""
    table = np.full(1 << 16, 32, np.uint32)
    for code in range(1 << 16):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


_TABLE: list[np.ndarray] = []


def _letters(data: np.ndarray) -> np.ndarray:
    """Code points of UTF-8 bytes: letters in lower case, others blank, one blank for a run."""
    if not _TABLE:
        _TABLE.append(_letter_table())
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    table = _TABLE[0]
    if len(codes) and codes.max() >= len(table):
        plain = np.where(codes < len(table), table[np.minimum(codes, 0xFFFF)], codes)
    else:
        plain = table[codes]
    keep = plain != 32
    keep[1:] |= keep[:-1].copy()
    return plain[keep]


def _counts(data: np.ndarray, size: int) -> np.ndarray:
    """Counts of the hashed n-grams of one text, with a blank at either end."""
    own = _letters(data)
    letters = np.full(len(own) + 2, 32, np.uint64)
    letters[1:-1] = own
    shift = np.uint64(64 - (size.bit_length() - 1))
    code = np.zeros(len(letters), np.uint64)
    grams = []
    for n in _GRAMS:
        code = (code[: len(letters) - n + 1] << np.uint64(21)) | letters[n - 1 :]
        grams.append(code * np.uint64(4) + np.uint64(n))
    slots = mix(np.concatenate(grams)) >> shift
    return np.bincount(slots.astype(np.int64), minlength=size)


def _vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights of one text; no weights if it has no feature."""
    at = np.flatnonzero(counts)
    values = np.log1p(counts[at]) * idf[at]
    norm = math.sqrt(float(values @ values))
    return at, values / norm if norm else values


@dataclass(frozen=True)
class LanguageModel:
    labels: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        at, values = _vector(counts, self.idf)
        return _softmax((values @ self.weights[at] + self.bias) / self.temperature)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _frequencies(texts: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Documents that have each feature, and documents, over all training texts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for _, data, offsets in runs(batches):
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                total[:size] += _counts(data[a:b], size) > 0
                total[size] += 1
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["n"])

    parts = texts.select("text").mapInArrow(count, "n binary").rdd
    total = parts.map(lambda row: np.frombuffer(row[0], np.int64)).treeAggregate(
        np.zeros(size + 1, np.int64), np.add, np.add, 3
    )
    return total[:size], int(total[size])


def _sample(train: DataFrame, per_label: int, max_labels: int) -> DataFrame:
    """The ``per_label`` texts of each label with the smallest key.

    Keys are ranked without the texts; the last key of each label, at most ``max_labels`` of them,
    then filters the texts where they are read.
    """
    ranked = train.select("label", "key").withColumn(
        "rank", F.row_number().over(Window.partitionBy("label").orderBy("key"))
    )
    last = ranked.where(F.col("rank") <= per_label).groupBy("label").agg(F.max("key").alias("last"))
    rows = last.orderBy("label").limit(max_labels + 1).collect()
    if len(rows) > max_labels:
        raise ValueError(f"more than {max_labels} labels")
    if not rows:
        return train.where(F.lit(False))
    bounds = F.create_map(*[F.lit(v) for r in rows for v in (r["label"], r["last"])])
    return train.where(F.col("key") <= F.try_element_at(bounds, F.col("label")))


def _sample_vectors(sample: DataFrame, idf: np.ndarray) -> list[tuple[str, int, np.ndarray, np.ndarray]]:
    size = len(idf)

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in runs(batches):
            places, values = [], []
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                at, value = _vector(_counts(data[a:b], size), idf)
                places.append(at.astype(np.int32).tobytes())
                values.append(value.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("label"),
                    batch.column("key"),
                    pa.array(places, pa.binary()),
                    pa.array(values, pa.binary()),
                ],
                names=["label", "key", "places", "vals"],
            )

    schema = "label string, key long, places binary, vals binary"
    rows = sample.select("label", "key", "text").mapInArrow(build, schema).collect()
    return sorted(
        (
            (r.label, r.key, np.frombuffer(r.places, np.int32), np.frombuffer(r.vals, np.float32))
            for r in rows
        ),
        key=lambda r: (r[1], r[0], r[2].tobytes()),
    )


def _train(
    rows: list, labels: tuple[str, ...], size: int, alpha: float, beta: float, l1: float, l2: float, epochs: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias after ``epochs`` passes in the order of the rows."""
    z = np.zeros((size + 1, len(labels)))
    n = np.zeros_like(z)
    place = {label: i for i, label in enumerate(labels)}

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
        return np.where(np.abs(z) > l1, shrunk, 0.0)

    for _ in range(epochs):
        for label, _, at, values in rows:
            at = np.append(at, size)
            x = np.append(values, 1.0)
            w = weights(z[at], n[at])
            error = _softmax(x @ w)
            error[place[label]] -= 1.0
            g = x[:, None] * error[None, :]
            squared = n[at] + g * g
            z[at] += g - (np.sqrt(squared) - np.sqrt(n[at])) / alpha * w
            n[at] = squared
    w = weights(z, n)
    return w[:size], w[size]


def _temperature(logits: np.ndarray, right: np.ndarray) -> float:
    """The temperature with the least negative log likelihood, by golden section on its log."""
    if not len(right):
        return 1.0

    def loss(t: float) -> float:
        p = _softmax(logits / math.exp(t))
        return float(-np.log(np.maximum(p[np.arange(len(right)), right], 1e-12)).mean())

    lo, hi, ratio = math.log(0.05), math.log(10.0), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return math.exp((lo + hi) / 2)


def train_language_model(
    documents: DataFrame,
    text: Column,
    label: Column,
    key: Column,
    per_label: int = 512,
    bits: int = 15,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.01,
    l2: float = 0.1,
    epochs: int = 4,
    max_labels: int = 500,
) -> LanguageModel:
    """Fit a model to the rows whose text, label and key are not null; ``key`` orders the sample.

    More than ``max_labels`` labels are refused: weights and sample grow with them.
    """
    train = documents.select(
        text.cast("string").alias("text"),
        label.cast("string").alias("label"),
        F.xxhash64(key.cast("string")).alias("key"),
        key.isNotNull().alias("known"),
    ).where("known and text is not null and label is not null")
    size = 1 << bits
    seen, total = _frequencies(train, size)
    idf = np.log((1 + total) / (1 + seen)) + 1.0
    rows = _sample_vectors(_sample(train, per_label, max_labels), idf)
    labels = tuple(sorted({r[0] for r in rows}, key=lambda s: s.encode()))
    if not labels:
        return LanguageModel((), idf, np.zeros((size, 0)), np.zeros(0), 1.0)
    held = [r for i, r in enumerate(rows) if i % 5 == 4]
    rest = [r for i, r in enumerate(rows) if i % 5 != 4]
    weights, bias = _train(rest, labels, size, alpha, beta, l1, l2, epochs)
    logits = np.array([r[3] @ weights[r[2]] + bias for r in held]).reshape(len(held), len(labels))
    right = np.array([labels.index(r[0]) for r in held], int)
    return LanguageModel(labels, idf, weights, bias, _temperature(logits, right))


def identify(
    documents: DataFrame,
    model: LanguageModel,
    text_column: str = "text",
    label_name: str = "lang_pred",
    score_name: str = "score",
) -> DataFrame:
    """The input with the predicted label and its calibrated probability."""
    kept = [f for f in documents.schema.fields if f.name not in (label_name, score_name)]
    schema = T.StructType(
        [*kept, T.StructField(label_name, T.StringType()), T.StructField(score_name, T.DoubleType())]
    )
    lettered = documents.select(
        *[F.col(f"`{f.name}`") for f in kept],
        F.coalesce(F.col(f"`{text_column}`").rlike(r"\p{L}"), F.lit(False)).alias("__lettered"),
    )
    shared = documents.sparkSession.sparkContext.broadcast(model)
    size = len(model.idf)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch, data, offsets in runs(batches, text_column):
            labels, scores = [], []
            asked = batch.column("__lettered").to_pylist()
            for yes, a, b in zip(asked, offsets[:-1], offsets[1:], strict=True):
                if not yes or not known.labels:
                    labels.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = known.probabilities(_counts(data[a:b], size))
                best = int(np.argmax(p))
                labels.append(known.labels[best])
                scores.append(float(p[best]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names[:-1], label_name, score_name],
            )

    return lettered.mapInArrow(predict, schema)
