"""Bitmaps of hashed keys: filters that never lose a member.

Their size has a proven bound: ``bitmap`` has 2^bits bits (2^24 are 2 MB), and
``sized_bitmap`` 16 to 32 bits a key up to 2^26 (8 MB). With very many keys a bitmap
lets more through; an exact join always follows, so that costs time and changes no
result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24
#: bounds of the bits of a bitmap that is sized by its keys
SIZED_BITS = (15, 26)


def position(key: Column, bits: int = BITS) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit((1 << bits) - 1))


def bitmap(positions: DataFrame, bits: int = BITS) -> np.ndarray:
    """uint64 words of the bitmap; ``positions`` has one long column in [0, 2^bits).
    At most 2^bits / 64 rows come to the driver."""
    pos = F.col(positions.columns[0])
    rows = (
        positions.groupBy(F.shiftright(pos, 6).alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(`{positions.columns[0]}` & 63 as int))")).alias("bits"))
        .toPandas()
    )
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def has(words: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Flags of the positions (uint64) that are set."""
    return ((words[(pos >> np.uint64(6)).astype(np.int64)] >> (pos & np.uint64(63))) & np.uint64(1)).astype(bool)


def sized_bitmap(keys: DataFrame) -> tuple[np.ndarray, int]:
    """Bytes of the bitmap of the low bits of a column of hashes (longs), and its
    number of bits. It comes to the driver in blocks of 4 KB."""
    key = F.col(keys.columns[0])
    bits = min(max(math.ceil(math.log2(16 * keys.count() + 1)), SIZED_BITS[0]), SIZED_BITS[1])
    at = key.bitwiseAND(F.lit((1 << bits) - 1))
    blocks = keys.groupBy(F.shiftright(at, 15).alias("block")).agg(F.bitmap_construct_agg(at.bitwiseAND(F.lit(32767))).alias("bits"))
    out = np.zeros(((1 << bits) >> 15, 4096), np.uint8)
    for block, part in blocks.collect():
        out[block] = np.frombuffer(part, np.uint8)
    return out.ravel(), bits


def in_bitmap(bitmap: np.ndarray, bits: int, key: np.ndarray) -> np.ndarray:
    """Flags of the hashes (uint64) whose low bits are set."""
    at = (key & np.uint64((1 << bits) - 1)).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
