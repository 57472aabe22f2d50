"""Spelling variants: words of a corpus that differ by one code point, found by pivotal grams.

Every word has its bigrams in one global order, rare ones first, and of equal ones the first place. Its
prefix are the three rarest; among them, dynamic programming chooses the two disjoint ones that the
fewest words hold, its pivots. One edit destroys at most one of two disjoint grams, so
of two near words one's pivot survives in the other's prefix: pivots are looked up among the prefix
grams of all words.

Position limits keep the lookup narrow. One edit lies on one side of the gram that survives, so all on
its other side is equal, gram included, and belongs to the key, which also fixes the place of the
gram. Of the side with the edit, one half is equal too: the half nearer the gram or the farther one.
The key holds that half, and the smaller of the two lengths that this side has in both words, which a
word can only know up to one; so it is filed under both. Candidates that share a key are verified by
edit distance inside the join.

Rows and edge cases: a null text has no words; a null id is written as nothing in front of a run's
hash. Rows that repeat an id count each. Texts are read as a stream of runs of any number; a task
holds a bounded table of counts. Ties between forms go to the smaller word in code-point order. An
empty table, or one without frequent words, gives no rows. Other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.session import cut_lineage, drop_work

#: Letters of a word after A-Z are lowered: 90 code points, so at most 8,100 bigrams.
LETTERS = "a-zÀ-ÿ"
GRAM = 2
EDITS = 1
#: Distinct words that a task counts before it hands them on.
_COUNTED = 1 << 17

Corrupt = Callable[[str, str], str]


def drop_one_in(divisor: int) -> Corrupt:
    """Deletes one letter of the runs whose hash with the document's id the divisor divides."""

    def corrupt(key: str, run: str) -> str:
        code = zlib.crc32(f"{key}:{run}".encode())
        at = code % len(run)
        return run if code % divisor else run[:at] + run[at + 1 :]

    return corrupt


def count_words(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_chars: int = 5,
    min_count: int = 3,
    corrupt: Corrupt | None = None,
) -> DataFrame:
    """``word, n``: runs of letters, A-Z lowered, of ``min_chars`` or more, and how often they occur.

    ``corrupt`` may change a run by its document's id, equally for all its occurrences there.
    """
    if min_chars < GRAM * EDITS + GRAM:
        raise ValueError("shorter words don't have the grams that the search needs")
    # A shorter run can't become a longer word, and greedy runs of this length are whole runs.
    pattern = f"[{LETTERS}]{{{min_chars},}}"
    rows = documents.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("key"),
        F.col(text_column).cast("string").alias("text"),
    ).where(F.col("text").isNotNull())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, counts = re.compile(pattern).finditer, Counter()

        def flush() -> pa.RecordBatch:
            words = pa.array(list(counts), pa.string())
            sums = pa.array(list(counts.values()), pa.int64())
            counts.clear()
            return pa.RecordBatch.from_arrays([words, sums], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch["key"], batch["text"], strict=True):
                key = key.as_py()
                lowered = text.as_buffer().to_pybytes().lower().decode()
                for found, n in Counter(m[0] for m in find(lowered)).items():
                    word = found if corrupt is None else corrupt(key, found)
                    if len(word) >= min_chars:
                        counts[word] += n
                if len(counts) >= _COUNTED:
                    yield flush()
        yield flush()

    return (
        rows.mapInArrow(run, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= min_count)
    )


def gram_weights(words: DataFrame) -> dict[str, int]:
    """How many places of all words each bigram has; the alphabet bounds their number."""
    places = F.sequence(F.lit(1), F.length("word") - (GRAM - 1))
    grams = words.select(
        F.explode(F.transform(places, lambda at: F.substring("word", at, F.lit(GRAM)))).alias("gram")
    )
    return {r.gram: r.n for r in grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()}


def prefix_grams(
    word: str, weights: dict[str, int]
) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Place and weight of the three rarest grams, by place, and of all that the word is filed under.

    Equal grams are ordered by place. One edit can move a gram by one place, and so past the third of
    its kind: those of the third kind count up to one place further.
    """
    order = sorted((weights[word[i : i + GRAM]], word[i : i + GRAM], i) for i in range(len(word) - 1))
    weight, gram, place = order[GRAM * EDITS]
    filed = [(i, w) for w, g, i in order if (w, g, i) <= (weight, gram, place + EDITS)]
    return sorted(filed[: GRAM * EDITS + 1]), filed


def pivots(grams: list[tuple[int, int]], count: int = EDITS + 1) -> list[int]:
    """Places of the ``count`` disjoint grams of least weight together.

    ``best[i][k]`` is the least weight, with its places, of k disjoint grams among the first i.
    """
    best: list[list[tuple[int, tuple[int, ...]] | None]] = [[(0, ()), *[None] * count]]
    for i, (place, weight) in enumerate(grams):
        free = sum(p + GRAM <= place for p, _ in grams[:i])
        row = list(best[i])
        for k in range(1, count + 1):
            if (before := best[free][k - 1]) is not None:
                taken = (before[0] + weight, (*before[1], place))
                if row[k] is None or taken < row[k]:
                    row[k] = taken
        best.append(row)
    return list(best[-1][count][1])


def _keys(word: str, place: int) -> Iterator[str]:
    """All keys under which a word is filed by the gram at a place."""
    for side, whole in (("<", word), (">", word[::-1])):
        # Mirrored, the side behind the gram is always the one that may hold the edit.
        end = (place if side == "<" else len(word) - place - GRAM) + GRAM
        fixed, open_side = whole[:end], whole[end:]
        for least in (len(open_side), len(open_side) - 1):
            if least < 0:
                continue
            near = least // 2
            yield f"{side}{least}:{fixed}{open_side[:near]}"
            if near:
                yield f"{side}{least}:{fixed}|{open_side[len(open_side) - (least - near) :]}"


def near_pairs(words: DataFrame) -> DataFrame:
    """``word, n, other, other_n``: every word with every word one edit away, both ways round."""
    weights = gram_weights(words)

    def file(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, names, counts, probes = [], [], [], []
            for word, n in zip(batch["word"].to_pylist(), batch["n"].to_pylist(), strict=True):
                rarest, grams = prefix_grams(word, weights)
                chosen = pivots(rarest)
                for place, _ in grams:
                    for key in _keys(word, place):
                        keys.append(key)
                        names.append(word)
                        counts.append(n)
                        probes.append(place in chosen)
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array(keys, pa.string()),
                    "word": pa.array(names, pa.string()),
                    "n": pa.array(counts, pa.int64()),
                    "pivot": pa.array(probes, pa.bool_()),
                }
            )

    filed = cut_lineage(
        words.select("word", "n")
        .mapInArrow(file, "key string, word string, n long, pivot boolean")
        .withColumns({"key": F.xxhash64("key")}),
        "grams",
    )
    asked = filed.where("pivot").select("key", "word", "n")
    held = filed.select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
    close = (F.abs(F.length("word") - F.length("other")) <= EDITS) & (
        F.levenshtein("word", "other", EDITS) == EDITS
    )
    found = asked.join(held, (asked["key"] == held["key"]) & close).select(
        "word", "n", "other", "other_n"
    )
    both = F.array(
        F.struct("word", "n", "other", "other_n"),
        F.struct(
            F.col("other").alias("word"),
            F.col("other_n").alias("n"),
            F.col("word").alias("other"),
            F.col("n").alias("other_n"),
        ),
    )
    return found.select(F.inline(both)).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: forms followed to their end, twice as far each round.

    A form is at least twice as frequent as its word, so a chain is as long as a logarithm of counts.
    """
    at = cut_lineage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = cut_lineage(
            at.join(further, "root", "left").select(
                "word",
                F.coalesce("further", "root").alias("root"),
                F.col("further").isNotNull().alias("moved"),
            ),
            "roots",
        )
        drop_work(at)
        at = moved
        if at.where("moved").isEmpty():
            return at.select("word", "root")


def group_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every row of ``word, n``; words are distinct.

    ``form`` is the most frequent near word if it is at least ``ratio`` times as frequent; ``root``
    is where the forms end.
    """
    words = cut_lineage(words.select("word", "n"), "words")
    most: Column = F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other").alias("form")))
    near = cut_lineage(
        near_pairs(words)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), most.alias("most"))
        .select("word", "n_near", "most.form", (-F.col("most.rank")).alias("form_n")),
        "near",
    )
    takes = F.col("form_n") >= ratio * F.col("n")
    told = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(takes, F.col("form")).alias("form"),
        F.when(takes, F.col("form_n")).alias("form_n"),
    )
    roots = _roots(told.where(F.col("form").isNotNull()))
    return told.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
