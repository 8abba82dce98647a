"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature is cut into quantile bins. Cyclic boosting visits the features in
turn; a shallow tree over a feature's bins fits the current gradient and is added,
shrunk, to that feature's lookup table. Then the pairs of features that explain
most of what is left get two-dimensional tables in the same way. What remains is
a sum of table entries, so a document is scored by looking up its bins.

Training takes a bounded sample of the labelled documents (``MOST_ROWS``); counts
and scores cover every document and its whole text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.features import text_features
from tillroll.llm.scratch import ready, written

#: rows of the training sample at most, one for each labelled id
MOST_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE = 300, 150, 0.1
_RIDGE = 1.0

#: name -> (numerator, denominator) over the counts of a text; the last are logs
RATIOS = {
    "symbols per word": ("n_symbols", "n_words"),
    "bangs per word": ("n_bangs", "n_words"),
    "marks per word": ("n_marks", "n_words"),
    "stops per word": ("n_stops", "n_words"),
    "digits per letter": ("n_digits", "word_chars"),
    "capitals per letter": ("n_upper", "word_chars"),
    "letters per word": ("word_chars", "n_words"),
    "bytes per letter": ("n_bytes", "word_chars"),
    "long words": ("n_long_words", "n_words"),
    "short words": ("n_short_words", "n_words"),
    "distinct words": ("n_distinct_words", "n_words"),
    "repeated words": ("n_repeat_words", "n_words"),
    "repeated lines": ("n_dup_lines", "n_lines"),
    "words per line": ("n_words", "n_lines"),
}
LOGS = ("n_words", "n_lines")
INPUTS = [*RATIOS, *(f"log {c}" for c in LOGS)]


def inputs(counts: dict[str, np.ndarray]) -> np.ndarray:
    """(rows, features) from the counts; a text without words gives zeros."""
    cols = [counts[a] / np.maximum(counts[b], 1) for a, b in RATIOS.values()]
    return np.column_stack([*cols, *(np.log1p(counts[c]) for c in LOGS)]).astype(np.float64)


@dataclass
class Additive:
    """Bin edges, lookup tables of features and of pairs, and the base score."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, (e, t) in enumerate(zip(self.edges, self.tables)):
            out += t[np.searchsorted(e, x[:, j], "right")]
        for (i, j), t in zip(self.pairs, self.pair_tables):
            out += t[np.searchsorted(self.pair_edges[i], x[:, i], "right"), np.searchsorted(self.pair_edges[j], x[:, j], "right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins)) if len(x) else np.zeros(0)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of ordered bins (0: no cut)."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gt, ht = g.sum(), h.sum()
    gain = gl**2 / (hl + _RIDGE) + (gt - gl) ** 2 / (ht - hl + _RIDGE) - gt**2 / (ht + _RIDGE)
    gain[(hl < 0.5) | (ht - hl < 0.5)] = 0  # leaves need some weight
    if not len(gain) or gain.max() <= 0:
        return 0.0, 0
    best = int(gain.argmax())
    return float(gain[best]), best + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values per bin of a tree with at most 2^depth leaves."""
    out = np.full(len(g), g.sum() / (h.sum() + _RIDGE))
    gain, at = _cut(g, h) if depth else (0.0, 0)
    if at:
        out[:at], out[at:] = _tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A tree that cuts one feature, then the other on both sides; the better order."""
    best, out = 0.0, np.full(g.shape, g.sum() / (h.sum() + _RIDGE))
    for turn in (False, True):
        gg, hh = (g.T, h.T) if turn else (g, h)
        gain, at = _cut(gg.sum(axis=1), hh.sum(axis=1))
        if not at:
            continue
        leaf, total = np.empty(gg.shape), gain
        for part in (slice(None, at), slice(at, None)):
            more, cut = _cut(gg[part].sum(axis=0), hh[part].sum(axis=0))
            total += more
            for side in (slice(None, cut), slice(cut, None)) if cut else (slice(None),):
                leaf[part, side] = gg[part, side].sum() / (hh[part, side].sum() + _RIDGE)
        if total > best:
            best, out = total, leaf.T if turn else leaf
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Boost the tables on four fifths of the rows; the number of rounds is where
    the rest has its smallest loss. Rows of one class, or none, give a constant."""
    model = Additive(base=float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    d = x.shape[1]
    model.edges = [_edges(x[:, j], BINS) for j in range(d)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(d)]
    if len(y) < 10 or y.min() == y.max():
        return model
    test = np.arange(len(y)) % 5 == 4
    train = ~test
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    f = np.full(len(y), model.base)

    def probability():
        return 1 / (1 + np.exp(-np.clip(f, -30, 30)))

    def loss():
        p = np.clip(probability()[test], 1e-9, 1 - 1e-9)
        return -np.mean(y[test] * np.log(p) + (1 - y[test]) * np.log(1 - p))

    def boost(rounds, step, state):
        best, kept, since = loss(), [t.copy() for t in state()], 0
        for _ in range(rounds):
            step()
            now = loss()
            if now < best - 1e-6:
                best, kept, since = now, [t.copy() for t in state()], 0
            else:
                since += 1
                if since >= 30:
                    break
        return kept

    def one_cycle():
        nonlocal f
        for j, b in enumerate(bins):
            p = probability()
            g = np.bincount(b[train], (y - p)[train], len(model.tables[j]))
            h = np.bincount(b[train], (p * (1 - p))[train], len(model.tables[j]))
            leaf = RATE * _tree(g, h)
            model.tables[j] += leaf
            f = f + leaf[b]

    model.tables = boost(ROUNDS, one_cycle, lambda: model.tables)
    f = model.margin(x)
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.pair_edges)]
    size = [len(e) + 1 for e in model.pair_edges]

    def grids(i, j):
        p = probability()
        cell = (coarse[i] * size[j] + coarse[j])[train]
        shape = (size[i], size[j])
        return (np.bincount(cell, (y - p)[train], size[i] * size[j]).reshape(shape),
                np.bincount(cell, (p * (1 - p))[train], size[i] * size[j]).reshape(shape))

    gains = sorted(((_pair_tree(*grids(i, j))[0], i, j) for i in range(d) for j in range(i)), reverse=True)
    model.pairs = [(i, j) for gain, i, j in gains[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((size[i], size[j])) for i, j in model.pairs]

    def pair_cycle():
        nonlocal f
        for k, (i, j) in enumerate(model.pairs):
            leaf = RATE * _pair_tree(*grids(i, j))[1]
            model.pair_tables[k] += leaf
            f = f + leaf[coarse[i], coarse[j]]

    if model.pairs:
        model.pair_tables = boost(PAIR_ROUNDS, pair_cycle, lambda: model.pair_tables)
    return model


def training_rows(features: DataFrame, labels: DataFrame, learn, doc_id: str = "doc_id", most: int = MOST_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Inputs and labels of ``most`` labelled ids at most, the first by a hash of the id;
    ``learn`` is a condition on the id. Labels other than 0 and 1, and documents whose
    labels disagree, are left out. An id gives one row however often it repeats: of
    different texts that with the smallest counts."""
    good = (
        labels.where(labels["quality"].isin(0, 1) & learn(labels[doc_id])).groupBy(labels[doc_id].alias("_label_id"))
        .agg(F.min("quality").alias("_y"), F.max("quality").alias("_z")).where("_y = _z")
    )
    h = F.pmod(F.xxhash64("_label_id"), F.lit(1 << 40))
    # twice as many as are wanted, so that few rows are sorted and sent; then an exact cut
    some = good.where(h < int((1 << 40) * min(1.0, 2 * most / max(good.count(), 1))))
    one = features.join(some, features[doc_id] == F.col("_label_id")).groupBy("_label_id", "_y").agg(F.min(F.struct(*INPUT_COUNTS)).alias("_x"))
    rows = one.orderBy(h, "_label_id").limit(most).select("_y", *[F.col(f"_x.{c}").alias(c) for c in INPUT_COUNTS]).toPandas()
    return inputs({c: rows[c].to_numpy(np.float64) for c in INPUT_COUNTS}), rows["_y"].to_numpy(np.float64)


INPUT_COUNTS = sorted({c for ab in RATIOS.values() for c in ab} | set(LOGS))


def score(features: DataFrame, model: Additive, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, score, predicted) of every row of the counts."""
    shared = features.sparkSession.sparkContext.broadcast(model)
    src = features.select(features[doc_id].alias("_id"), *INPUT_COUNTS)
    schema = T.StructType([src.schema["_id"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches):
        for batch in batches:
            x = inputs({c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in INPUT_COUNTS})
            s = shared.value.score(x)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=schema.names)

    return src.mapInArrow(run, schema).withColumnRenamed("_id", doc_id)


def classify(docs: DataFrame, labels: DataFrame, learn, doc_id: str = "doc_id", text: str = "text", most: int = MOST_ROWS) -> DataFrame:
    """Score every document of ``docs`` (a row per row; doc_id, score, predicted).

    The score uses counts of the whole text and nothing else. Null and empty texts
    count as texts without words and get a score too; equal texts get equal scores;
    without usable labels the score is the prior (0.5 for none); an empty table
    gives an empty result; other columns aren't read.
    """
    ready(docs.sparkSession)
    features = written(text_features(docs, [doc_id], text), "classifier-features")
    return score(features, fit(*training_rows(features, labels, learn, doc_id, most)), doc_id)
