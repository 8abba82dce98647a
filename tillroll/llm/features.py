"""Countable features of whole texts, one row of longs per document."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillroll.llm import arrays as A
from tillroll.llm.scratch import ready

#: name -> what it counts over the whole text (null text: 0 each)
FEATURES = {
    "n_bytes": "UTF-8 bytes",
    "n_words": "runs of characters other than ASCII white space",
    "word_chars": "code points in words",
    "n_symbols": "characters of #*$%&|<>",
    "n_lines": "lines with a word",
    "n_dup_lines": "lines with a word, equal to an earlier line",
    "n_repeat_words": "words in 3-word windows found twice or more",
    "n_distinct_words": "distinct words",
    "n_upper": "A-Z",
    "n_digits": "0-9",
    "n_marks": "ASCII punctuation other than the symbols",
    "n_bangs": "characters ! and ?",
    "n_stops": "words that end in a full stop",
    "n_long_words": "words of over 20 bytes",
    "n_short_words": "words of 1 or 2 bytes",
}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MARK = np.zeros(256, bool)
_MARK[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True
_MARK &= ~_SYMBOL
_CLASSES = {
    "n_symbols": _SYMBOL,
    "n_upper": np.isin(np.arange(256), np.arange(65, 91)),
    "n_digits": np.isin(np.arange(256), np.arange(48, 58)),
    "n_marks": _MARK,
    "n_bangs": np.isin(np.arange(256), list(b"!?")),
    # code points in words: bytes that start one and aren't white space
    "word_chars": ~A.SPACE & ~((np.arange(256) >= 0x80) & (np.arange(256) < 0xC0)),
}


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _per_byte(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(flags)
    return np.diff(np.searchsorted(at, offsets))


def _distinct(h: np.ndarray) -> int:
    if len(h) < 2:
        return len(h)
    s = np.sort(h)
    return 1 + int(np.count_nonzero(s[1:] != s[:-1]))


def _repeated(win: np.ndarray, n_words: int, k: int) -> int:
    """Words covered by windows whose hash occurs twice or more."""
    order = np.argsort(win)
    s = win[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(win), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n_words, bool)
    for j in range(k):
        covered[j : j + len(win)] |= twice
    return int(np.count_nonzero(covered))


def count(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """All features of the rows of one block."""
    starts, ends, first = A.words(raw, offsets)
    h = A.span_hash(raw, starts, ends)
    width = ends - starts
    out = {"n_bytes": np.diff(offsets), "n_words": np.diff(first)}
    for name, table in _CLASSES.items():
        out[name] = _per_byte(table[raw], offsets)
    out["n_stops"] = _sums(raw[ends - 1] == 46, first) if len(ends) else np.zeros(len(offsets) - 1, np.int64)
    out["n_long_words"] = _sums(width > 20, first)
    out["n_short_words"] = _sums(width < 3, first)
    # lines: runs between newlines that hold at least one word
    ls, le, _ = A.spans(raw != 10, offsets)
    held = np.searchsorted(starts, le) > np.searchsorted(starts, ls) if len(ls) else np.zeros(0, bool)
    ls, le = ls[held], le[held]
    lfirst = np.searchsorted(ls, offsets)
    lh = A.span_hash(raw, ls, le)
    out["n_lines"] = np.diff(lfirst)
    win, n_win = A.windows(h, first, 3)
    at = np.concatenate([[0], np.cumsum(n_win)])
    n = len(offsets) - 1
    dup, rep, dis = (np.zeros(n, np.int64) for _ in range(3))
    for i in range(n):
        dis[i] = _distinct(h[first[i] : first[i + 1]])
        dup[i] = out["n_lines"][i] - _distinct(lh[lfirst[i] : lfirst[i + 1]])
        if n_win[i] > 1:
            rep[i] = _repeated(win[at[i] : at[i + 1]], int(first[i + 1] - first[i]), 3)
    out |= {"n_distinct_words": dis, "n_dup_lines": dup, "n_repeat_words": rep}
    return out


def text_features(docs: DataFrame, keep: list[str], text: str = "text", named: bool = True) -> DataFrame:
    """The columns ``keep`` of every document and its FEATURES as longs.

    Null text counts as empty (all zero); repeated rows give repeated rows; an
    empty table gives an empty table; other columns of ``docs`` are not read.
    """
    ready(docs.sparkSession)
    names = [f"_k{i}" for i in range(len(keep))]
    src = docs.select(*[docs[c].alias(n) for c, n in zip(keep, names)], docs[text].alias("_text"))
    schema = T.StructType(
        [T.StructField(n, src.schema[n].dataType) for n in names]
        + [T.StructField(f, T.LongType()) for f in FEATURES]
    )

    def run(batches):
        for batch in batches:
            for part in A.blocks(batch, "_text"):
                f = count(*A.utf8(part.column("_text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array(f[x], pa.int64()) for x in FEATURES],
                    names=[*names, *FEATURES],
                )

    out = src.mapInArrow(run, schema)
    return out.withColumnsRenamed(dict(zip(names, keep))) if named else out
