"""Words of whole Arrow batches of texts, found and hashed with numpy.

A batch is worked on in slices of a quarter of a megabyte that end between texts, so the memory in use
does not depend on the batch. One text is never cut.

Hashes are polynomials over random 64-bit values of the bytes (modulo 2**64), mixed at the end.
They identify words, lines and runs of words; two of n different ones collide with a probability
of about n**2 / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18

_BYTES = np.arange(256)
#: Bytes of words that end at white space only: all but blank, \t, \n, \v, \f and \r.
NOT_SPACE = ~np.isin(_BYTES, [0x20, *range(0x09, 0x0E)])
#: Bytes of words of lower-case letters, digits and anything beyond ASCII.
ALNUM = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
#: Lower-cases A-Z, leaves all other bytes.
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

_VALUES = np.random.default_rng(20240506).integers(1, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int, base: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse, grown when a longer text comes."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + SLICE_BYTES // 4)
            self.up, self.down = _powers(size, _BASE), _powers(size, pow(_BASE, -1, 2**64))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit over all others."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Rolling:
    """Hashes of any run of a sequence of 64-bit values, from one pass over it."""

    def __init__(self, values: np.ndarray) -> None:
        up, self._down = _POWERS.get(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[:-1], out=self._sums[1:])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._down[starts])

    def grams(self, k: int) -> np.ndarray:
        """The hash of the k values from each position on, as far as there are k."""
        n = len(self._sums) - 1
        if n < k:
            return np.zeros(0, dtype=np.uint64)
        return mix((self._sums[k:] - self._sums[: n - k + 1]) * self._down[: n - k + 1])


@dataclass
class Words:
    """Words of some texts: byte ranges in ``data``, and where each text's words begin.

    ``first_row`` is the number of the first text in its batch. ``offsets`` has the texts' byte
    ranges, ``of_text`` the texts' word ranges.
    """

    data: np.ndarray
    offsets: np.ndarray
    first_row: int
    starts: np.ndarray
    ends: np.ndarray
    of_text: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.of_text)

    @cached_property
    def text_of(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    @cached_property
    def bytes_hashed(self) -> Rolling:
        return Rolling(_VALUES[self.data])

    @cached_property
    def hashes(self) -> np.ndarray:
        return self.bytes_hashed.runs(self.starts, self.ends)

    @cached_property
    def rolling(self) -> Rolling:
        return Rolling(self.hashes)

    def whole(self, k: int) -> np.ndarray:
        """Which word positions begin a run of k words within one text."""
        n = max(0, len(self.starts) - k + 1)
        return self.text_of[:n] == self.text_of[k - 1 :][:n]

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per word, by text."""
        sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return sums[self.of_text[1:]] - sums[self.of_text[:-1]]


def text_slices(
    column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, bytes) of runs of texts of about ``limit`` bytes. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    column = column.fill_null(b"") if column.null_count else column
    if not len(column):
        return
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, offsets[row : end + 1] - offsets[row], data[offsets[row] : offsets[end]]
        row = end


def edges(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values, cut where a text begins."""
    n = len(inside)
    before, after = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def words(
    column: pa.Array | pa.ChunkedArray, letters: np.ndarray = NOT_SPACE, lower: bool = False
) -> Iterator[Words]:
    """The words of a column of binary texts, slice by slice."""
    for row, offsets, data in text_slices(column):
        data = LOWER[data] if lower else data
        starts, ends = edges(letters[data], offsets)
        yield Words(data, offsets, row, starts, ends, np.searchsorted(starts, offsets))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive values, as far as there are so many."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def minimizers(values: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the minimum of some ``width`` consecutive values, all ties included."""
    if len(values) < width:
        return np.zeros(0, dtype=np.int64)
    lowest = sliding_min(values, width)
    # The largest minimum among the windows that hold a position is the value itself if it is one.
    padded = np.concatenate([np.zeros(width - 1, np.uint64), lowest, np.zeros(width - 1, np.uint64)])
    return np.flatnonzero(~sliding_min(~padded, width) == values)


def covered(n: int, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """Which of n positions lie in one of the ranges."""
    change = np.bincount(starts, minlength=n + 1)[: n + 1].astype(np.int64)
    change -= np.bincount(starts + lengths, minlength=n + 1)[: n + 1]
    return np.cumsum(change[:n]) > 0
