"""Words and word windows of Arrow text columns as numpy arrays, without Python strings.

A word is a run of bytes other than space and the control characters 9 to 13; in UTF-8 these bytes
never occur inside another character. Words and windows are named by 64-bit polynomial hashes over
prefix sums (modulo 2**64, odd base), so any window costs a few array steps whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in runs of rows of about this many bytes; one longer text is a run alone.
RUN_BYTES = 1 << 20

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Blanks and ASCII punctuation.
PUNCTUATED = _BLANK.copy()
PUNCTUATED[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(values: np.ndarray) -> np.ndarray:
    """Bit mixer on unsigned 64-bit values; one to one."""
    with np.errstate(over="ignore"):
        v = values ^ (values >> np.uint64(30))
        v = v * np.uint64(0xBF58476D1CE4E5B9)
        v ^= v >> np.uint64(27)
        v = v * np.uint64(0x94D049BB133111EB)
        return v ^ (v >> np.uint64(31))


def _power_tables(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    up, down = _powers.get(base, (np.empty(0, np.uint64),) * 2)
    if len(up) < size:
        size = max(size, RUN_BYTES + 1)
        steps = np.empty((2, size), np.uint64)
        steps[0], steps[1] = base, pow(base, -1, 1 << 64)
        steps[:, 0] = 1
        up, down = np.cumprod(steps, axis=1, dtype=np.uint64)
        _powers[base] = (up, down)
    return up, down


class Windows:
    """Hashes of any runs of a value sequence."""

    def __init__(self, values: np.ndarray, base: int = _WORD_BASE) -> None:
        self._up, self._down = _power_tables(base, len(values) + 1)
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self._up[: len(values)], out=sums[1:])
        self._sums = sums

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One hash for each run [start, end); runs of other lengths differ as well."""
        raw = (self._sums[ends] - self._sums[starts]) * self._down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


@dataclass
class Words:
    """Words of a run of rows: byte places of each word and the first word of each row."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return Windows(self.data.astype(np.uint64) + np.uint64(1), _BYTE_BASE).hashes(
            self.starts, self.ends
        )

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def windows(self, size: int) -> np.ndarray:
        """Starts of all windows of ``size`` words that lie inside one row."""
        at = np.arange(len(self.starts))
        last = np.repeat(self.first[1:], np.diff(self.first))
        return at[at + size <= last]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the first byte of each row; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    if len(column) == 0 or places is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = RUN_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``limit`` bytes, with the bytes and row places of the text."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield (
                batch.slice(at, end - at),
                data[offsets[at] : offsets[end]],
                offsets[at : end + 1] - offsets[at],
            )
            at = end


def words_of(
    data: np.ndarray, offsets: np.ndarray, lower: bool = False, blank: np.ndarray = _BLANK
) -> Words:
    """The words of each row; ``lower`` maps A-Z to a-z, ``blank`` tells the bytes between words."""
    if lower:
        data = _LOWER[data]
    solid = ~blank[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    begins, stops = solid.copy(), solid.copy()
    if len(data):
        begins[1:] &= ~solid[:-1] | edge[1:-1]
        stops[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets))


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as signed numbers, for Spark's long."""
    return values.view(np.int64)
