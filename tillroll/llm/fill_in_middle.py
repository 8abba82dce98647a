"""Fill-in-middle transformation over line boundaries kept in a roaring-style set.

The offsets of a text's line ends are a sorted set of integers. It is cut into
chunks of 2^16 offsets; each chunk is kept as the smallest of three containers: a
sorted array of 16-bit offsets, a bitmap of 2^16 bits, or runs of consecutive
offsets. Cumulative cardinalities of the containers (and, within a bitmap, of its
words; within runs, of the runs) turn "the k-th line end" into a search for the
container and a local select. Both cuts of a text are two such selects.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import arrays as A
from tillroll.llm.scratch import ready

SEED = 7
#: percent of the texts that are transformed, and of those the percent in spm form
FIM_PERCENT, SPM_PERCENT = 100, 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CHUNK_BITS = 16
_CHUNK = 1 << CHUNK_BITS
_NEWLINE = 10


class ArrayContainer:
    """Sorted 16-bit offsets."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    @staticmethod
    def cost(low: np.ndarray) -> int:
        return 2 * len(low)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """2^16 bits with the cumulative cardinalities of the 64-bit words."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(_CHUNK, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.begin = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    @staticmethod
    def cost(low: np.ndarray) -> int:
        return _CHUNK // 8

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.begin, k, "right")) - 1
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[k - int(self.begin[word])])


class RunContainer:
    """First offsets of runs of consecutive offsets, with cumulative lengths."""

    def __init__(self, low: np.ndarray):
        first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
        self.start = low[first].astype(np.uint16)
        self.begin = np.append(first, len(low))

    @staticmethod
    def cost(low: np.ndarray) -> int:
        return 4 * int(np.count_nonzero(np.diff(low, prepend=-2) != 1))

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.begin, k, "right")) - 1
        return int(self.start[run]) + k - int(self.begin[run])


class BoundarySet:
    """A set of offsets, given in ascending order."""

    def __init__(self, offsets: np.ndarray):
        chunk = offsets >> CHUNK_BITS
        first = np.flatnonzero(np.diff(chunk, prepend=-1))
        self.base = chunk[first] << CHUNK_BITS
        self.begin = np.append(first, len(offsets))
        self.containers = []
        for i, base in enumerate(self.base):
            low = offsets[self.begin[i] : self.begin[i + 1]] - base
            kind = min((ArrayContainer, RunContainer, BitmapContainer), key=lambda c: c.cost(low))
            self.containers.append(kind(low))

    def __len__(self) -> int:
        return int(self.begin[-1])

    def select(self, k: int) -> int:
        """The k-th smallest offset, k from 0."""
        i = int(np.searchsorted(self.begin, k, "right")) - 1
        return int(self.base[i]) + self.containers[i].select(k - int(self.begin[i]))

    def cut(self, units: int) -> int:
        """Bytes in the first ``units`` units, of which offset k ends unit k."""
        return self.select(units - 1) + 1 if units else 0


def line_ends(raw: np.ndarray) -> np.ndarray:
    """Offsets of the last byte of each line; a last line needs no line end."""
    ends = np.flatnonzero(raw == _NEWLINE)
    return ends if not len(raw) or raw[-1] == _NEWLINE else np.append(ends, len(raw) - 1)


def characters(raw: np.ndarray) -> int:
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def arrange(raw: np.ndarray, draws: list[int], fim_percent: int, spm_percent: int) -> tuple:
    """(n lines, form, prefix characters, middle characters, output bytes)."""
    lines, whole = BoundarySet(line_ends(raw)), raw.tobytes()
    n = len(lines)
    if not n or draws[2] % 100 >= fim_percent or any(s.encode() in whole for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, whole
    a, b = sorted(lines.cut(x % (n + 1)) for x in draws[:2])
    prefix, middle, suffix = whole[:a], whole[a:b], whole[b:]
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    spm = draws[3] % 100 < spm_percent
    output = s + suffix + p + prefix + m + middle if spm else p + prefix + s + suffix + m + middle
    return n, "spm" if spm else "psm", characters(raw[:a]), characters(raw[a:b]), output


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED,
                   fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """One row per row of ``docs``: the id, ``n`` (lines), ``form`` (plain, psm, spm),
    ``prefix_chars``, ``middle_chars`` (null if plain) and ``output``.

    The draws are the first four 8-digit groups of the sha256 of ``seed:id``, so a row
    gets the same cuts wherever and however often it is read; repeated rows are cut
    alike, and a null id counts as the empty string. Null and empty texts, and texts
    that contain a sentinel, are plain (a null text's output is empty). Empty tables
    give empty results; other columns of ``docs`` aren't read.
    """
    ready(docs.sparkSession)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(docs[doc_id].cast("string"), F.lit("")))
    src = docs.select(docs[doc_id].alias("_id"), docs[text].alias("_text"), F.sha2(key, 256).alias("_draws"))
    schema = T.StructType([
        T.StructField("_id", src.schema["_id"].dataType), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType()),
    ])

    def run(batches):
        for batch in batches:
            for part in A.blocks(batch, "_text"):
                raw, offsets = A.utf8(part.column("_text"))
                rows = []
                for i, h in enumerate(part.column("_draws").to_pylist()):
                    draws = [int(h[j : j + 8], 16) for j in (0, 8, 16, 24)]
                    rows.append(arrange(raw[offsets[i] : offsets[i + 1]], draws, fim_percent, spm_percent))
                n, form, prefix, middle, output = map(list, zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                    names=schema.names)

    return src.mapInArrow(run, schema).withColumnRenamed("_id", doc_id)


def restored(output: Column, form: Column) -> Column:
    """The text, rebuilt from what ``fill_in_middle`` returns."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)  # before the first sentinel there is nothing
    return (
        F.when(form == "psm", F.concat(part[1], part[3], part[2]))
        .when(form == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(output)
    )
