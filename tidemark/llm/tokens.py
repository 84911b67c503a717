"""Vectorised words and shingles of Arrow string columns (plain numpy, used inside tasks).

Work goes in slices of bounded size, so memory follows the slice and the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE_BYTES = 1 << 19
SLICE_DOCS = 1024
#: bits of a shingle's hash; the other 10 hold its document's place in a slice while sorting
HASH_BITS = 54


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x + U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BASE = 0x100000001B3 * 0x9E3779B1 % (1 << 64) | 1
_POWERS: dict = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random value of each byte, powers of an odd base and of its inverse modulo 2**64."""
    size = _POWERS.get("size", 0)
    if size < n:
        size = max(n, 2 * SLICE_BYTES)
        up, down = np.full(size, _BASE, U), np.full(size, pow(_BASE, -1, 1 << 64), U)
        up[0] = down[0] = 1
        _POWERS.update(size=size, up=np.cumprod(up), down=np.cumprod(down), table=mix64(np.arange(256, dtype=U) + U(77)))
    return _POWERS["table"], _POWERS["up"], _POWERS["down"]


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows; nulls count as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset: texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, "right")) - 1
        j = min(max(j, i + 1), i + SLICE_DOCS, n)
        yield i, raw[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]
        i = j


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CONTENT = np.ones(256, bool)
_CONTENT[[32, 9, 10, 11, 12, 13]] = False


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every word of a slice."""
    n = len(raw)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    content = _CONTENT[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = content[:-1]
    starts = np.flatnonzero(content & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = content[1:]
    ends = np.flatnonzero(content & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def range_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range."""
    table, up, down = _powers(len(raw) + 1)
    sums = np.empty(len(raw) + 1, U)
    sums[0] = 0
    np.cumsum(table[raw] * up[: len(raw)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U))


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``k``-word shingles of all documents of a slice, sorted within each,
    and their offsets. ASCII letters count as small; fewer words than ``k`` make one shingle."""
    docs = len(offsets) - 1
    starts, ends, doc = words(raw, offsets)
    h = range_hashes(_LOWER[raw], starts, ends)
    count = np.bincount(doc, minlength=docs)
    m = len(h)
    full = np.zeros(m, bool)
    if m >= k:
        full[: m - k + 1] = doc[: m - k + 1] == doc[k - 1:]
    i = np.flatnonzero(full)
    x = np.zeros(len(i), U)
    for t in range(k):
        x = mix64(x ^ h[i + t])
    d = doc[i]
    few = np.flatnonzero((count > 0) & (count < k))
    if len(few):
        first = np.searchsorted(doc, few)
        y = np.full(len(few), 1, U)
        for t in range(k - 1):
            there = count[few] > t
            y = np.where(there, mix64(y ^ h[np.minimum(first + t, m - 1)]), y)
        x, d = np.concatenate([x, y]), np.concatenate([d, few])
    key = (d.astype(U) << U(HASH_BITS)) | (x >> U(64 - HASH_BITS))
    key.sort()
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    d = (key >> U(HASH_BITS)).astype(np.int64)
    out = np.zeros(docs + 1, np.int64)
    np.cumsum(np.bincount(d, minlength=docs), out=out[1:])
    return key & U((1 << HASH_BITS) - 1), out
