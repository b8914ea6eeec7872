"""Vectorised tokenising and hashing of Arrow text columns.

Texts are handled as UTF-8 bytes: both word definitions used by the operators split on ASCII bytes only, so a byte
table decides what belongs to a word, and every byte above 0x7F is a word byte.  Words are identified by a mixed
64-bit polynomial hash, which the Jaccard join and the decontamination go by; token counts, search and phrases take the
words themselves (`word_array`).  Nulls are read as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Most bytes tokenised at a time; a single longer text is taken alone and whole.
CHUNK_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words are runs of anything but ASCII white space.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Words are runs of ASCII letters and digits and of anything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = 0xD6E8FEB86659FD93 | 1
_BYTE_VALUE = np.random.default_rng(20240101).integers(1, 2**63, 256, dtype=np.uint64)


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.up[:n], self.down[:n]


_CHAR_POWERS, _WORD_POWERS = _Powers(_BASE), _Powers(_STEP)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _window_sums(values: np.ndarray, powers: _Powers, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = powers.get(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


@dataclass
class Words:
    """The words of some rows: rows first..first+n_rows of a batch, their bytes, and where each word lies."""

    first: int
    n_rows: int
    data: np.ndarray
    row_bytes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # of each row's words: row r has words bounds[r]..bounds[r+1]
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_rows), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every run of n words within one row."""
        if n == 1:
            return np.arange(len(self.hashes)), mix(self.hashes)
        last = len(self.hashes) - n + 1
        if last <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        rows = self.rows
        at = np.flatnonzero(rows[:last] == rows[n - 1 :])
        return at, mix(_window_sums(self.hashes, _WORD_POWERS, at, at + n) + np.uint64(n))


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and its n + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)), at


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets from 0) of runs of whole rows of about `limit` bytes."""
    data, at = buffers(column)
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield first, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def spans(data: np.ndarray, row_bytes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of table's bytes, which never cross rows, and each row's first word."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = table[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[row_bytes] = True
    here, before = inside[1:], inside[:-1]
    starts = np.flatnonzero(here & (~before | edge))
    ends = np.flatnonzero(before & (~here | edge))
    return starts, ends, np.searchsorted(starts, row_bytes)


def words(column: pa.Array, table: np.ndarray = SPACED, limit: int = CHUNK_BYTES) -> Iterator[Words]:
    """The lower-cased (A-Z only) words of each run of rows, with their hashes."""
    for first, raw, row_bytes in chunks(column, limit):
        data = LOWER[raw]
        starts, ends, bounds = spans(data, row_bytes, table)
        hashes = mix(_window_sums(_BYTE_VALUE[data], _CHAR_POWERS, starts, ends) + (ends - starts).astype(np.uint64))
        yield Words(first, len(row_bytes) - 1, data, row_bytes, starts, ends, bounds, hashes)


def prefixes(w: Words, n: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the first n bytes of the words, or those at `at` (shorter words: of the whole word and its length)."""
    starts, ends = (w.starts, w.ends) if at is None else (w.starts[at], w.ends[at])
    up, sums = _CHAR_POWERS.get(n)[0], np.zeros(len(starts), dtype=np.uint64)
    for k in range(n):
        sums += np.where(starts + k < ends, _BYTE_VALUE[w.data[np.minimum(starts + k, ends - 1)]] * up[k], np.uint64(0))
    return mix(sums + np.uint64(n << 32))


def by_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each row, in order of row and value; rows must be sorted."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[new], values[new]


def word_array(data: np.ndarray, table: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words themselves, as `spans` finds them with the same table, one after the other."""
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[table[data]])])
