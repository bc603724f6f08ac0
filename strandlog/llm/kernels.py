"""Vectorised text kernels shared by the operators of this subpackage.

Everything here is plain numpy over the byte buffer of an Arrow string column: no per-row Python.
A word is a maximal run of bytes other than U+0020 and U+0009..U+000D.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: The bytes that separate words.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Text handled at once, in bytes. Keeps the 8-byte work arrays of a block inside tens of MB.
BLOCK_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
_TABLE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_PINV = np.uint64(pow(int(_P), -1, 1 << 64))
WORD_KEYS = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers (the finaliser of splitmix64) that spreads every input bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i modulo 2**64 for i in 0..n; grown as needed and kept."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, 1 << 16)
        up, down = np.full(size, _P), np.full(size, _PINV)
        up[0] = down[0] = 1
        _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0], _powers[1]


def prefix_hash(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """c with c[i] = sum of T[data[k]] * P**k for k < i, so substring hashes are differences."""
    up, _ = powers(len(data))
    c = np.empty(len(data) + 1, np.uint64)
    c[0] = 0
    np.cumsum((_LOWER if lower else _TABLE)[data] * up[: len(data)], out=c[1:])
    return c


def spans_hash(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free hash of the byte ranges [start, end), from ``prefix_hash``."""
    _, down = powers(len(c))
    return mix((c[end] - c[start]) * down[start])


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string or binary column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def blocks(offs: np.ndarray, limit: int = BLOCK_BYTES):
    """(first, past) row ranges of about ``limit`` bytes; a longer text is a block of its own."""
    n, at = len(offs) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield at, to
        at = to


def words(data: np.ndarray, offs: np.ndarray, between: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and n + 1 offsets of each text's words. ``between``: bytes outside words."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offs), np.int64)
    ink = np.zeros(n + 2, bool)
    np.logical_not(between[data], out=ink[1:-1])
    first = ink[1:] & ~ink[:-1]  # at i: a word starts at i; at n: never
    last = ~ink[1:] & ink[:-1]  # at i: a word ended before i
    cut = offs[(offs > 0) & (offs < n)]
    joint = cut[ink[cut] & ink[cut + 1]]  # words that touch across two texts
    first[joint] = last[joint] = True
    start, end = np.flatnonzero(first), np.flatnonzero(last)
    return start, end, np.searchsorted(start, offs)


def windows(h: np.ndarray, word_offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words inside a text, and n + 1 offsets of each text's runs.

    A text with fewer words, but at least one, gives one run: the whole sequence.
    """
    count = np.diff(word_offs)
    runs = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    run_offs = np.concatenate(([0], np.cumsum(runs)))
    at = np.arange(run_offs[-1]) + np.repeat(word_offs[:-1] - run_offs[:-1], runs)
    length = np.repeat(np.minimum(count, width), runs)
    out = length.astype(np.uint64) * WORD_KEYS[63]
    short = bool((count < width).any())
    top = len(h) - 1
    for k in range(width):
        if short:
            inside = k < length
            out += np.where(inside, h[np.minimum(at + k, top)] * WORD_KEYS[k], np.uint64(0)) if len(at) else out
        else:
            out += h[at + k] * WORD_KEYS[k]
    return mix(out), run_offs
