"""Vectorised byte scans over Arrow text columns.

Texts of one Arrow batch are cut into slices of whole documents (about
``SLICE_BYTES`` each, one document at least) and every slice is handled as
one flat ``uint8`` array with document offsets.  Memory is about 50 bytes
per byte of a slice; Arrow's freed buffers go back to the system after each
batch, so that an idle worker holds little.  A null text counts as empty.

Token hashes are 64-bit: a position-weighted sum over random byte values,
finished by a mixing function.  Two different words agree with a chance of
about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
U64 = np.uint64

_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE_VALUE = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64) | U64(1)
_STEP = int(_rng.integers(1, 1 << 63, dtype=np.uint64)) | 1
_powers = np.ones(1, dtype=np.uint64)

#: separators of `[^\x20\x09-\x0D]+`
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: separators of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of an odd step, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        p = np.full(max(n, 2 * len(_powers)), _STEP, dtype=np.uint64)
        p[0] = 1
        _powers = np.cumprod(p, dtype=np.uint64)
    return _powers[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column (null: empty)."""
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    _, off, data = col.buffers()
    if len(col) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offsets = np.frombuffer(off, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(col: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole documents."""
    data, off = flat(col)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + size, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi
    pa.default_memory_pool().release_unused()


@dataclass
class Words:
    """Words of one slice, in order: byte range, document row and hash."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # index of the first word of each document; len = documents + 1
    hash: np.ndarray


def runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true bytes; runs end at document ends."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, dtype=bool)
    cut[off] = True
    prev = np.empty(n, dtype=bool)
    prev[0] = False
    prev[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~prev | cut[:n]))
    nxt = np.empty(n, dtype=bool)
    nxt[-1] = False
    nxt[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~nxt | cut[1:])) + 1
    return start, end


def range_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of non-empty, disjoint, ascending byte ranges."""
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    ln = end - start
    at = np.cumsum(ln) - ln
    within = np.arange(int(ln.sum()), dtype=np.int64) - np.repeat(at, ln)
    values = BYTE_VALUE[data[np.repeat(start, ln) + within]]
    values *= powers(int(ln.max()))[within]
    h = np.add.reduceat(values, at)
    return mix(h + ln.astype(np.uint64) * U64(0x9E3779B97F4A7C15))


def words(data: np.ndarray, off: np.ndarray, separator: np.ndarray = SPACE) -> Words:
    start, end = runs(~separator[data], off)
    first = np.searchsorted(start, off, "left")
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    return Words(start, end, doc, first, range_hash(data, start, end))


def windows(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Word index and hash of every run of ``k`` words inside one document."""
    n = len(w.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(w.doc[:n] == w.doc[k - 1:])
    h = np.zeros(len(at), dtype=np.uint64)
    for j, p in enumerate(powers(k + 1)[1:]):
        h += w.hash[at + j] * p
    return at, mix(h)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document row, hash) of distinct ``k``-word shingles, sorted by both.

    A document of fewer than ``k`` words has its whole sequence as one.
    """
    at, h = windows(w, k)
    doc = w.doc[at] if len(at) else np.zeros(0, np.int64)
    count = np.diff(w.first)
    for m in range(1, k):
        short = np.flatnonzero(count == m)
        if len(short):
            s = np.zeros(len(short), dtype=np.uint64)
            for j, p in enumerate(powers(m + 1)[1:]):
                s += w.hash[w.first[short] + j] * p
            doc = np.concatenate([doc, short])
            h = np.concatenate([h, mix(s + U64(m))])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    if len(h):
        new = np.ones(len(h), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
        doc, h = doc[new], h[new]
    return doc, h


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and per-row counts."""
    off = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values, kind))
