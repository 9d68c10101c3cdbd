"""Array helpers that several operators of this package share: Arrow text
columns as byte arrays, polynomial prefix hashes, word boundaries."""

from __future__ import annotations

import ctypes
from functools import wraps

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the n + 1 offsets of its rows.  A null row
    is an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string()) if column.null_count else column.cast(pa.large_string())
    _, offs, data = column.buffers()
    o = np.frombuffer(offs, np.int64, count=len(column) + 1, offset=8 * column.offset)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[o[0]:o[-1]], o - o[0]


def row_blocks(offsets: np.ndarray, max_bytes: int):
    """Cut rows into consecutive blocks ``(first, end)`` of about
    ``max_bytes``; a longer row is a block of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + max_bytes, side="right")) - 1
        end = min(n, max(end, first + 1))
        yield first, end
        first = end


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i modulo 2**64 for i < n (one table per process, which
    grows by powers of two)."""
    if not _powers or len(_powers[0][0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        _powers.clear()
        with np.errstate(over="ignore"):
            up = np.full(size, _BASE, U64)
            up[0] = 1
            down = np.full(size, _BASE_INV, U64)
            down[0] = 1
            _powers.append((np.cumprod(up, out=up), np.cumprod(down, out=down)))
    up, down = _powers[0]
    return up[:n], down[:n]


def give_back() -> None:
    """Free memory of this worker goes back to the system: Spark keeps idle
    workers beside those of later stages."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)


def returns_memory(work):
    """A function for ``mapInArrow`` that gives memory back when its task
    ends."""
    @wraps(work)
    def run(batches):
        yield from work(batches)
        give_back()
    return run


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x = x * U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """C with C[i] = sum of (byte + 1) * P**j over j < i, so the hash of
    raw[a:b] is (C[b] - C[a]) * P**-a."""
    up, _ = powers(len(raw) + 1)
    out = np.zeros(len(raw) + 1, U64)
    np.cumsum((raw.astype(U64) + U64(1)) * up[:len(raw)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hash of every raw[start:end]."""
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


# lower-cased A-Z; words are runs of digits, a-z and bytes from 0x80 on
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = True
_WORD[0x61:0x7B] = True
_WORD[0x80:] = True


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, word starts, word ends, and per row the index of
    its first word (n + 1 entries).  Words never cross rows."""
    low = LOWER[raw]
    is_word = _WORD[low]
    cut = np.zeros(len(raw) + 1, bool)          # a row begins here
    cut[offsets] = True
    before = np.empty(len(raw), bool)
    after = np.empty(len(raw), bool)
    if len(raw):
        before[0] = after[-1] = False
        before[1:] = is_word[:-1]
        after[:-1] = is_word[1:]
        before[cut[:-1]] = False
        after[cut[1:]] = False
    start = np.flatnonzero(is_word & ~before)
    end = np.flatnonzero(is_word & ~after) + 1
    return low, start, end, np.searchsorted(start, offsets)


def flat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of arange(s, s + n) for every (s, n)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
