"""Runs of bytes of a class in the texts of an Arrow column, as Arrow strings (plain numpy, used inside tasks)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(inside) -> np.ndarray:
    """256 flags; all bytes of characters beyond ASCII are inside."""
    flags = np.zeros(256, bool)
    flags[list(inside)] = True
    flags[128:] = True
    return flags


def runs(raw: np.ndarray, offsets: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of every longest run of ``content`` bytes (one flag a byte) that does not cross texts."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(content & (edge[:-1] | np.concatenate([[True], ~content[:-1]])))
    ends = np.flatnonzero(content & (edge[1:] | np.concatenate([~content[1:], [True]]))) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def strings(raw: np.ndarray, content: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.LargeStringArray:
    """The runs as strings, in their order."""
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(raw[content])))
