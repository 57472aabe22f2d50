"""Text normalisation, similarity and blocking keys."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keys given to records whose blocking field is missing or empty.
UNKNOWN_KEY = "__unknown__"
NO_DOMAIN_KEY = "__no_domain__"
NO_PHONE_KEY = "__no_phone__"
EMPTY_NAME_KEY = "__empty__"
UNATTRIBUTED_KEY = "__unattributed__"

PREFIX_SCALE = 0.1
MAX_PREFIX = 4

_NON_ASCII = r"[^\x00-\x7F]"


@F.pandas_udf(T.StringType())
def _fold_to_ascii(values: pd.Series) -> pd.Series:
    return values.map(
        lambda v: None
        if v is None
        else unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode("ascii")
    )


@F.pandas_udf(T.StringType())
def _decompose(values: pd.Series) -> pd.Series:
    return values.map(
        lambda v: None if v is None else unicodedata.normalize("NFKD", v.strip().lower())
    )


def _only_non_ascii(text: Column) -> Column:
    """Null for plain ASCII, so that those rows send nothing to a Python worker."""
    return F.when(text.rlike(_NON_ASCII), text)


def normalise(value: Column, ascii_only: bool = False) -> Column:
    """Compatibility-decompose, drop non-ASCII, collapse blanks, trim, lower.

    ``ascii_only`` promises that the column holds ASCII text; the plan then has no Python step.
    """
    text = value.cast("string")
    if not ascii_only:
        text = F.coalesce(_fold_to_ascii(_only_non_ascii(text)), text)
    return F.lower(F.trim(F.regexp_replace(text, r"[\s\x1c-\x1f]+", " ")))


def normalise_for_block(value: Column, ascii_only: bool = False) -> Column:
    """Trim, lower, compatibility-decompose; letters outside ASCII stay."""
    text = value.cast("string")
    plain = F.lower(F.regexp_replace(text, r"^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))
    if ascii_only:
        return plain
    return F.coalesce(_decompose(_only_non_ascii(text)), plain)


def email_domain_key(value: Column, ascii_only: bool = False) -> Column:
    text = normalise_for_block(value, ascii_only)
    return F.when(value.isNull(), F.lit(UNKNOWN_KEY)).otherwise(
        F.when(text.contains("@"), F.substring_index(text, "@", -1)).otherwise(F.lit(NO_DOMAIN_KEY))
    )


def phone_key(value: Column, ascii_only: bool = False) -> Column:
    digits = F.regexp_replace(normalise_for_block(value, ascii_only), r"[^\p{Nd}]", "")
    return F.when(value.isNull(), F.lit(UNKNOWN_KEY)).otherwise(
        F.when(digits == "", F.lit(NO_PHONE_KEY)).otherwise(F.substring(digits, 1, 7))
    )


def name_key(value: Column, ascii_only: bool = False) -> Column:
    letters = F.regexp_replace(normalise_for_block(value, ascii_only), r"[^\p{L}]", "")
    return F.when(value.isNull(), F.lit(UNKNOWN_KEY)).otherwise(
        F.when(letters == "", F.lit(EMPTY_NAME_KEY)).otherwise(
            F.lower(F.substring(letters, 1, 3))
        )
    )


def record_prefix_key(value: Column, ascii_only: bool = False) -> Column:
    text = normalise_for_block(value, ascii_only)
    return F.when(value.isNull(), F.lit(UNKNOWN_KEY)).otherwise(F.substring(text, 1, 8))


BLOCK_KEYS = {
    "email_domain": email_domain_key,
    "phone_normalized": phone_key,
    "name_first3": name_key,
    "record_id_prefix": record_prefix_key,
}


def tokens(normalised: Column) -> Column:
    """Distinct words of a normalised text; empty text has none."""
    return F.array_distinct(F.filter(F.split(normalised, " "), lambda t: t != ""))


def token_overlap(a: Column, b: Column) -> Column:
    """Shared words over all words; 0 when either side has none."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(
        shared.cast("double") / union
    )


_SET_WORDS = 4


def letter_slots(normalised: Column) -> Column:
    """A bit number per letter; the second ``a`` of a text is another item than the first."""
    letters = F.array_sort(F.filter(F.split(normalised, ""), lambda c: c != ""))
    return F.transform(
        letters,
        lambda c, i: F.pmod(
            F.xxhash64(c, i - F.array_position(letters, c).cast("int")), F.lit(64 * _SET_WORDS)
        ).cast("int"),
    )


def letter_profile(normalised: Column, slots: Column) -> Column:
    """What the similarity bound needs of a text, computed once per value.

    ``w0..w3`` is the set of its letters as 256 bits; ``lost`` counts letters that fell on a bit
    already set; ``size`` is the length and ``share`` its inverse; ``p1..p4`` are hashes of the
    leading letters. ``slots`` is ``letter_slots`` of the text, as a column of its own so that it is
    evaluated once.
    """

    def word(n: int) -> Column:
        mine = F.filter(slots, lambda x: (x >= 64 * n) & (x < 64 * n + 64))
        one = F.lit(1).cast("long")
        return F.aggregate(
            mine,
            F.lit(0).cast("long"),
            lambda acc, x: acc.bitwiseOR(F.call_function("shiftleft", one, x - 64 * n)),
        )

    size = F.greatest(F.length(normalised), F.lit(1))
    return F.struct(
        *[word(n).alias(f"w{n}") for n in range(_SET_WORDS)],
        (size - F.size(F.array_distinct(slots))).alias("lost"),
        size.alias("size"),
        (F.lit(1.0) / size).alias("share"),
        *[F.xxhash64(F.rpad(F.substring(normalised, 1, n), n, "\x00")).alias(f"p{n}") for n in range(1, MAX_PREFIX + 1)],
    )


def jaro_winkler_bound(a: Column, b: Column) -> Column:
    """A value the Jaro-Winkler similarity of two profiled texts never exceeds.

    Matching letters are at most the letters both texts have: the common bits plus the letters that
    share a bit, of which the smaller count suffices. Without half transpositions and with prefix
    ``p``, the similarity is ``0.1 p + (1 - 0.1 p) * jaro``. Each term appears once, which keeps the
    compiled join condition small.
    """
    common = F.lit(0)
    for n in range(_SET_WORDS):
        common = common + F.bit_count(a[f"w{n}"].bitwiseAND(b[f"w{n}"]))
    shared = F.least(common + F.least(a["lost"], b["lost"]), a["size"], b["size"])
    jaro = (shared * (a["share"] + b["share"]) + 1.0) / 3.0
    prefix = F.lit(0)
    for n in range(1, MAX_PREFIX + 1):
        prefix = prefix + (a[f"p{n}"] == b[f"p{n}"]).cast("int")
    boost = prefix * PREFIX_SCALE
    return boost + (F.lit(1.0) - boost) * jaro


def jaro_winkler_text(first: str, second: str) -> float:
    """Jaro similarity raised by 0.1 per shared leading character, up to four, at any level."""
    if first == second:
        return 1.0
    n, m = len(first), len(second)
    if n == 0 or m == 0:
        return 0.0
    reach = max(n, m) // 2 - 1
    taken = bytearray(m)
    left: list[str] = []
    for i, ch in enumerate(first):
        j = second.find(ch, max(0, i - reach), min(i + reach + 1, m))
        while j >= 0 and taken[j]:
            j = second.find(ch, j + 1, min(i + reach + 1, m))
        if j >= 0:
            taken[j] = 1
            left.append(ch)
    hits = len(left)
    if hits == 0:
        return 0.0
    right = [second[j] for j in range(m) if taken[j]]
    half_swaps = sum(x != y for x, y in zip(left, right)) / 2
    jaro = (hits / n + hits / m + (hits - half_swaps) / hits) / 3
    prefix = 0
    for x, y in zip(first[:MAX_PREFIX], second[:MAX_PREFIX]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * PREFIX_SCALE * (1 - jaro)


def _codes(texts: np.ndarray) -> np.ndarray:
    """Character codes, one row per text, zero-padded."""
    fixed = texts.astype("U")
    return fixed.view(np.uint32).reshape(len(fixed), -1)


def jaro_winkler_batch(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """``jaro_winkler_text`` for arrays of non-empty texts, all pairs of a batch in step."""
    a, b = _codes(first), _codes(second)
    n, m = (a != 0).sum(axis=1), (b != 0).sum(axis=1)
    reach = np.maximum(n, m) // 2 - 1
    columns = np.arange(b.shape[1])
    hit_a = np.zeros(a.shape, dtype=bool)
    hit_b = np.zeros(b.shape, dtype=bool)
    rows = np.arange(len(a))
    for i in range(a.shape[1]):
        near = np.abs(columns[None, :] - i) <= reach[:, None]
        fits = (b == a[:, i, None]) & near & ~hit_b & (a[:, i, None] != 0)
        place = fits.argmax(axis=1)
        found = fits[rows, place]
        hit_a[found, i] = True
        hit_b[rows[found], place[found]] = True
    hits = hit_a.sum(axis=1)
    left = np.take_along_axis(a, np.argsort(~hit_a, axis=1, kind="stable"), axis=1)
    right = np.take_along_axis(b, np.argsort(~hit_b, axis=1, kind="stable"), axis=1)
    width = min(a.shape[1], b.shape[1])
    inside = np.arange(width)[None, :] < hits[:, None]
    half_swaps = ((left[:, :width] != right[:, :width]) & inside).sum(axis=1) / 2
    safe = np.maximum(hits, 1)
    jaro = np.where(hits == 0, 0.0, (hits / n + hits / m + (hits - half_swaps) / safe) / 3)
    head = min(MAX_PREFIX, width)
    same = (a[:, :head] == b[:, :head]) & (a[:, :head] != 0)
    prefix = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    score = jaro + prefix * PREFIX_SCALE * (1 - jaro)
    equal = (n == m) & (a[:, :width] == b[:, :width]).all(axis=1)
    return np.where(equal, 1.0, np.where(hits == 0, 0.0, score))


#: Texts up to this length are compared as bits of one word.
WORD_LETTERS = 64
_PAIRS_STEP = 1 << 16
_MASK_CELLS = 1 << 21


class _Texts:
    """Texts of one side, in classes of equal length: places, character numbers and ranks by length."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, rank: np.ndarray) -> None:
        order = np.lexsort((rank, lengths))
        self.classes = {}
        for n in np.unique(lengths):
            at = order[lengths[order] == n]
            self.classes[int(n)] = at, codes[at, : int(n)], rank[at]


def close_pairs(
    first: list[str], second: list[str], rank_first: np.ndarray, rank_second: np.ndarray, least: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places ``i, j`` and ``jaro_winkler_text(first[i], second[j])`` of the pairs that reach ``least``,
    above 0, of those with ``rank_first[i] < rank_second[j]``.

    The texts have at most 64 letters, none of them NUL. The letters of a text that are equal to a
    given one are bits of a word, so one step looks up a letter in many texts. Transpositions are
    counted for the pairs that could still reach ``least`` without any.
    """
    sizes = [np.fromiter(map(len, side), np.int64, len(side)) for side in (first, second)]
    letters = _codes(np.array([*first, *second, " "], dtype=object))
    known, numbers = np.unique(letters, return_inverse=True)
    numbers = numbers.reshape(letters.shape).astype(np.int32)
    left = _Texts(numbers[: len(first)], sizes[0], rank_first)
    right = _Texts(numbers[len(first) : -1], sizes[1], rank_second)
    wide = max(64, _MASK_CELLS // len(known))
    for m, (at_b, codes_b, ranks_b) in right.classes.items():
        for start in range(0, len(at_b), wide):
            some = slice(start, start + wide)
            masks = _masks(codes_b[some], len(known), m)
            for n, (at_a, codes_a, ranks_a) in left.classes.items():
                for i, j, score in _close(codes_a, ranks_a, codes_b[some], ranks_b[some], masks, least):
                    yield at_a[i], at_b[some][j], score


def _masks(codes: np.ndarray, letters: int, length: int) -> np.ndarray:
    """For each letter and text the places where the text has it, as bits."""
    kind = np.uint32 if length <= 32 else np.uint64
    masks = np.zeros((letters, len(codes)), kind)
    texts = np.arange(len(codes))
    for j in range(length):
        masks[codes[:, j], texts] |= kind(1 << j)
    return masks


def _close(
    a: np.ndarray, rank_a: np.ndarray, b: np.ndarray, rank_b: np.ndarray, masks: np.ndarray, least: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``close_pairs`` for the character numbers of texts of length n and of length m."""
    n, m, kind = a.shape[1], b.shape[1], masks.dtype.type
    if n == m <= 1:
        for i in range(len(a)):
            j = np.flatnonzero((b == a[i]).all(axis=1) & (rank_b > rank_a[i]))
            if least <= 1.0 and len(j):
                yield np.full(len(j), i), j, np.ones(len(j))
        return
    if not n or not m:
        return
    hits = np.arange(1, min(n, m) + 1)
    jaro = (hits / n + hits / m + 1.0) / 3
    fewest = np.array(
        [1 + np.count_nonzero(jaro + p * PREFIX_SCALE * (1 - jaro) < least - 1e-9) for p in range(MAX_PREFIX + 1)], np.uint8
    )
    if fewest[-1] > min(n, m):
        return
    reach = max(n, m) // 2 - 1
    every = (1 << m) - 1
    near = [kind(((1 << max(0, i + reach + 1)) - 1) & ~((1 << max(0, i - reach)) - 1) & every) for i in range(n)]
    head = min(MAX_PREFIX, n, m)
    found = np.empty((n, _PAIRS_STEP + len(b)), kind)
    row = 0
    while row < len(a):
        begin = int(np.searchsorted(rank_b, rank_a[row], "right"))
        width = len(b) - begin
        if not width:
            break
        rows = a[row : row + max(1, _PAIRS_STEP // width)]
        shape = len(rows), width
        free, seen = np.full(shape, kind(every)), np.empty(shape, kind)
        mine = masks[:, begin:]
        for x in range(n):
            low = found[x, : free.size].reshape(shape)
            np.take(mine, rows[:, x], axis=0, out=seen, mode="clip")
            np.bitwise_and(seen, free, out=seen)
            np.bitwise_and(seen, near[x], out=seen)
            np.negative(seen, out=low)
            np.bitwise_and(seen, low, out=low)
            np.bitwise_xor(free, low, out=free)
        same = rows[:, :1] == b[None, begin:, 0]
        prefix = same.astype(np.uint8)
        for k in range(1, head):
            same &= rows[:, k, None] == b[None, begin:, k]
            prefix += same
        enough = m - np.bitwise_count(free) >= fewest[prefix]
        ranks = rank_a[row : row + len(rows)]
        if rank_b[begin] <= ranks[-1]:
            enough &= rank_b[None, begin:] > ranks[:, None]
        at = np.flatnonzero(enough)
        if len(at):
            i, j = np.divmod(at, width)
            score = _scores(rows, i, found, at, ~free.ravel()[at] & kind(every), m, prefix.ravel()[at])
            good = score >= least
            yield row + i[good], begin + j[good], score[good]
        row += len(rows)


def _scores(
    a: np.ndarray, i: np.ndarray, found: np.ndarray, at: np.ndarray, taken: np.ndarray, m: int, prefix: np.ndarray
) -> np.ndarray:
    """Jaro-Winkler of the pairs ``at``, whose letter x of the first text matches the place that the bit
    of ``found[x]`` names. Both sides' matching letters are set side by side in their order."""
    n, pairs = a.shape[1], len(at)
    hits = np.bitwise_count(taken).astype(np.int64)
    # Row k holds the k-th matching letter of each pair; what matches nothing goes to a last row.
    last = min(n, m)
    left, right = (np.zeros((last + 1) * pairs, a.dtype) for _ in range(2))
    letters, own = np.ascontiguousarray(a.T), np.arange(pairs)
    count, one = own.copy(), found.dtype.type(1)
    for x in range(n):
        low = found[x].take(at)
        letter = letters[x].take(i)
        hit = low != 0
        left[count] = letter  # the next match writes over a letter without one
        rank = np.bitwise_count(taken & (low - one)).astype(np.int64)
        rank[~hit] = last
        right[rank * pairs + own] = letter
        count += hit * pairs
    left, right = left.reshape(last + 1, pairs)[:last], right.reshape(last + 1, pairs)[:last]
    inside = np.arange(last)[:, None] < hits
    half_swaps = ((left != right) & inside).sum(axis=0) / 2
    jaro = (hits / n + hits / m + (hits - half_swaps) / hits) / 3
    score = jaro + prefix * PREFIX_SCALE * (1 - jaro)
    return np.where((n == m) & (hits == n) & (half_swaps == 0), 1.0, score)


#: Characters of one array step: long texts go in small groups of their own length class.
_BATCH_CHARS = 1 << 18


def _length_groups(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Places of texts of about equal length, by powers of two, in groups of bounded size."""
    classes = np.ceil(np.log2(np.maximum(lengths, 2))).astype(int)
    for size in np.unique(classes):
        places = np.flatnonzero(classes == size)
        step = max(1, _BATCH_CHARS >> int(size))
        for at in range(0, len(places), step):
            yield places[at : at + step]


@F.pandas_udf(T.DoubleType())
def _jaro_winkler(first: pd.Series, second: pd.Series) -> pd.Series:
    """Jaro-Winkler over two columns of normalised text, one Arrow batch at a time."""
    out = np.full(len(first), np.nan)
    known = (first.notna() & second.notna()).to_numpy()
    a, b = first.to_numpy(dtype=object), second.to_numpy(dtype=object)
    sizes = first.str.len(), second.str.len()
    regular = known & (np.minimum(*sizes) > 0)
    regular &= ~(first.str.contains("\x00", regex=False).fillna(False) | second.str.contains("\x00", regex=False).fillna(False)).to_numpy(dtype=bool)
    where = np.flatnonzero(regular)
    longest = np.maximum(*sizes).to_numpy()[where]
    for group in _length_groups(longest):
        some = where[group]
        out[some] = jaro_winkler_batch(a[some], b[some])
    for i in np.flatnonzero(known & ~regular):
        out[i] = jaro_winkler_text(a[i], b[i])
    return pd.Series(out).where(known, None)


# Declared non-deterministic only so that a later filter on the score is not moved below it, which
# would make Spark compute the similarity twice.
jaro_winkler = _jaro_winkler.asNondeterministic()


@F.pandas_udf(T.DoubleType())
def round_score(scores: pd.Series) -> pd.Series:
    """Four decimals, rounded on the exact binary value; the built-in rounds the decimal text."""
    return pd.Series(round_four(scores.to_numpy(dtype=float)))


def round_four(values: np.ndarray) -> np.ndarray:
    """``round(v, 4)`` of each value. The product with 10,000 is off by less than what is called near to
    half here, so only values near to half need the exact one."""
    moved = values * 1e4
    out = np.rint(moved) / 1e4
    exact = ~(np.abs(np.abs(moved - np.trunc(moved)) - 0.5) > 1e-6) | ~(np.abs(moved) < 1e9)
    for i in np.flatnonzero(exact):
        out[i] = round(float(values[i]), 4)
    return out
