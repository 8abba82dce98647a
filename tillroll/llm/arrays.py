"""Word, line and shingle kernels over the raw UTF-8 buffer of an Arrow column.

Every kernel reads whole texts. A column is viewed as one byte array plus row
offsets, so no Python string is made per word; hashing works in blocks of a
fixed number of bytes, which bounds temporary memory for texts of any length.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BLOCK = 1 << 18
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_NO_OFFSET = np.zeros(1, np.int64)

# ASCII white space: the separators of the word pattern [^\x20\x09-\x0D]+
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([np.ones(1, U64), np.full(n, _BASE, U64)]), dtype=U64)
        inverse = U64(pow(int(_BASE), -1, 1 << 64))
        down = np.cumprod(np.concatenate([np.ones(1, U64), np.full(n, inverse, U64)]), dtype=U64)
    return up, down


def utf8(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets (null: empty text)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(pc.cast(col, pa.large_string()), "")
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), _NO_OFFSET.copy()
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset : col.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` bytes that don't cross a row: starts, ends, and
    for each row the index of its first run (length rows + 1)."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return spans(~SPACE[raw], offsets)


def span_hash(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes and length, from prefix sums of
    byte * base^position, taken in blocks of about ``_BLOCK`` bytes."""
    out = np.empty(len(starts), U64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            lo = int(starts[i])
            j = max(i + 1, int(np.searchsorted(ends, lo + _BLOCK, "right")))
            hi = int(ends[j - 1])
            up, down = _powers(max(_BLOCK, 1 << (hi - lo - 1).bit_length()) if hi > lo else _BLOCK)
            sums = np.empty(hi - lo + 1, U64)
            sums[0] = 0
            np.cumsum((raw[lo:hi].astype(U64) + U64(1)) * up[: hi - lo], out=sums[1:])
            s, e = starts[i:j] - lo, ends[i:j] - lo
            out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U64) * U64(0xD6E8FEB86659FD93))
            i = j
    return out


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z, every other byte as it is."""
    return np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)


def windows(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word windows that start at each word (the last k - 1 words
    of a row start none) and, per row, the number of its windows."""
    n = np.maximum(np.diff(first) - (k - 1), 0)
    if len(h) < k:
        return np.zeros(0, U64), n
    with np.errstate(over="ignore"):
        out = np.zeros(len(h) - k + 1, U64)
        for j in range(k):
            out = (out ^ h[j : len(h) - k + 1 + j]) * U64(0xC2B2AE3D27D4EB4F) + U64(j + 1)
            out ^= out >> U64(29)
        out = mix(out)
    starts_none = np.zeros(len(h) + 1, bool)
    for j in range(1, k):
        last = first[1:] - j
        starts_none[last[last >= first[:-1]]] = True
    return out[~starts_none[: len(out)]], n


def shingles(raw: np.ndarray, offsets: np.ndarray, k: int):
    """Per row, the sorted distinct hashes of its k-word shingles; a row of fewer
    words gives its whole word sequence as one; a row without words gives none."""
    starts, ends, first = words(raw, offsets)
    h = span_hash(raw, starts, ends)
    win, count = windows(h, first, k)
    at = np.concatenate([[0], np.cumsum(count)])
    for i in range(len(offsets) - 1):
        if count[i]:
            s = np.sort(win[at[i] : at[i + 1]])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif first[i + 1] > first[i]:
            few = h[first[i] : first[i + 1]]
            whole, _ = windows(few, np.array([0, len(few)]), len(few))
            yield mix(whole + U64(len(few)))
        else:
            yield np.zeros(0, U64)


def blocks(batch: pa.RecordBatch, column: str, most: int = 4 << 20):
    """Slices of a batch whose texts hold about ``most`` bytes (one row at least)."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    i = 0
    while i < len(lengths):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + most, "right")))
        yield batch.slice(i, j - i)
        i = j
