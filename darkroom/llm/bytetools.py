"""NumPy helpers over the bytes of a whole column of texts.

One Arrow string column is one byte buffer plus offsets. The helpers hash
every k-byte string of that buffer, or every word of it, with a handful of
array operations, so no per-character Python runs inside a task.

The polynomial hash works modulo 2**64. Each byte is first replaced by a
random odd-looking 64-bit value (a fixed table drawn from a seeded
generator) and results go through a 64-bit finaliser; tests compare the
operators built on it with brute force on whole texts.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240229)
BYTE_VALUES = _RNG.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INV = np.uint64(pow(int(BASE), -1, 1 << 64))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        kind = np.int32
    else:
        kind = np.int64
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, dtype=kind, count=n + 1, offset=column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]]
    return raw, at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (the public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """BASE**i (or its inverse) modulo 2**64 for i in [0, n)."""
    key = "inv" if inverse else "pow"
    have = _POWERS.get(key)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        out = np.full(size, BASE_INV if inverse else BASE, dtype=np.uint64)
        out[0] = 1
        have = _POWERS[key] = np.multiply.accumulate(out)
    return have[:n]


def release() -> None:
    """Give back the memory of a task: Spark keeps a Python worker for the next
    tasks, and a worker that packed texts held 480 MB until it was trimmed."""
    _POWERS.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def releasing(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`task`, a function of Arrow batches, with `release` at its end."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            release()

    return run


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[i] = sum over j < i of value(data[j]) * BASE**-j."""
    out = np.empty(len(data) + 1, dtype=np.uint64)
    out[0] = 0
    np.cumsum(BYTE_VALUES[data] * powers(len(data), inverse=True), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of data[start:stop]; equal strings hash alike wherever they lie."""
    return (prefix[stop] - prefix[start]) * powers(len(prefix))[start]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of x[i:i+w] for every i with a whole window."""
    have, width = x, 1
    while width * 2 <= w:
        have = np.minimum(have[:-width], have[width:])
        width *= 2
    if width < w:
        rest = w - width
        have = np.minimum(have[:len(have) - rest], have[rest:])
    return have


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the words `[^\\x20\\x09-\\x0D]+` of a byte buffer.

    Those white-space bytes never occur inside a UTF-8 sequence."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    return edge[0::2], edge[1::2]


def chunks(texts: list[bytes], size: int) -> Iterator[range]:
    """Index ranges over `texts` of about `size` bytes each; a longer text stands alone."""
    first = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > size:
            yield range(first, i)
            first, total = i, 0
        total += len(text) + 1
    if first < len(texts):
        yield range(first, len(texts))
