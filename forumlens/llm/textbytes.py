"""Byte-level helpers for Arrow text columns: whole batches are lower-cased,
split into words and dictionary-encoded with numpy and Arrow, never per row.

A null text is an empty text.  Words are cut at document borders.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# fixed values: byte classes of the two word definitions, after lower-casing
# A-Z.  Every byte of a non-ASCII character is >= 0x80, so both classes can
# be tested byte by byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NONSPACE = np.ones(256, dtype=bool)          # [^\x20\x09-\x0D]
NONSPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM = np.zeros(256, dtype=bool)            # [^\x00-\x2F\x3A-\x60\x7B-\x7F]
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """The public splitmix64 finalizer, element by element (mod 2^64)."""
    h = (h ^ (h >> _S30)) * _M1
    h = (h ^ (h >> _S27)) * _M2
    return h ^ (h >> _S31)


def text_buffer(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64)[col.offset:col.offset + len(col) + 1]
    if len(off) == 0:
        off = np.zeros(1, np.int64)
    data = (np.frombuffer(bufs[2], np.uint8)[off[0]:off[-1]]
            if bufs[2] is not None and off[-1] > off[0] else np.empty(0, np.uint8))
    return data, off - off[0]


class Words(NamedTuple):
    """Words of a batch: ``data``/``offsets`` hold their bytes one after
    another, ``first`` the index of each row's first word (rows + 1)."""
    data: np.ndarray
    offsets: np.ndarray
    first: np.ndarray

    def array(self) -> pa.Array:
        return binary_array(self.data, self.offsets)


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)),
         pa.py_buffer(np.ascontiguousarray(data))])


def split_words(data: np.ndarray, off: np.ndarray, keep: np.ndarray,
                lower: bool = True) -> Words:
    """Maximal runs of ``keep`` bytes, never across a row border."""
    low = LOWER[data] if lower else data
    mask = keep[low]
    start = mask.copy()
    start[1:] &= ~mask[:-1]
    rows = off[:-1][off[:-1] < off[1:]]
    start[rows] = mask[rows]
    pos = np.flatnonzero(start)
    comp = low[mask]
    offsets = np.append(np.flatnonzero(start[mask]), len(comp)).astype(np.int64)
    return Words(comp, offsets, np.searchsorted(pos, off))


def values_buffer(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a large_binary array."""
    bufs = values.buffers()
    off = np.frombuffer(bufs[1], np.int64)[values.offset:values.offset + len(values) + 1]
    data = (np.frombuffer(bufs[2], np.uint8)[off[0]:off[-1]]
            if len(values) and off[-1] > off[0] else np.empty(0, np.uint8))
    return data, off - off[0]


def hash_values(values: pa.Array) -> np.ndarray:
    """A 64-bit hash per value of a large_binary array (no value is empty)."""
    data, off = values_buffer(values)
    if len(values) == 0:
        return np.empty(0, np.uint64)
    length = np.diff(off)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(int(length.max()), _BASE, np.uint64))
        at = np.arange(len(data)) - np.repeat(off[:-1], length)
        h = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * power[at], off[:-1])
        return mix(h ^ (length.astype(np.uint64) * _M2))


def row_slices(off: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Cut rows into runs of at most ``most`` bytes (one longer row alone)."""
    out, a, n = [], 0, len(off) - 1
    while a < n:
        b = int(np.searchsorted(off, off[a] + most, "right")) - 1
        b = min(max(b, a + 1), n)
        out.append((a, b))
        a = b
    return out


def table_slices(batches, text, most: int):
    """Re-cut a stream of record batches into tables of about ``most`` text
    bytes: small batches are joined, large ones cut at rows."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, off = text_buffer(text(batch))
        for a, b in row_slices(off, most):
            part = int(off[b] - off[a])
            if held and size + part > most:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(batch.slice(a, b - a))
            size += part
    if held:
        yield pa.Table.from_batches(held)
