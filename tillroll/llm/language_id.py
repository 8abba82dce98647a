"""Language identification by cross-parsing entropy.

For each language the suffix automaton of a bounded piece of labelled text
recognises every substring of that text. A document is parsed greedily: from
each position the longest match in the automaton is one phrase. Few, long phrases
mean that the text is like the language. Phrases are normalised as in a cross
entropy, phrases * log2(training length) / text length, and the smallest value
wins (ties: the language that sorts first).

Letters are lower-cased and every run of other characters is one gap, so signs,
digits and layout carry no weight. Every letter of the training texts has a symbol;
one that a language's texts lack ends a phrase and is one itself. The rows of the
transition table are laid over each other, so a language costs memory for its text,
not for its alphabet. Texts are parsed whole, in windows of ``WINDOW`` symbols that run in lockstep
over arrays: a phrase also ends where a window does, alike for every language.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.arrays import blocks
from tillroll.llm.scratch import ready

UNKNOWN_LANGUAGE = "und"
#: bound of the training sample of each language: whole documents, their characters in
#: all, and the characters of one
DOCS_PER_LANGUAGE = 200
LANGUAGE_CHARS = 60_000
DOC_CHARS = 6_000
WINDOW = 256
_GAP, _UNKNOWN = 0, 1  # global symbols; letters follow
_MODELS: dict[str, "Languages"] = {}
_letter_table: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _letter_table
    if _letter_table is None:
        _letter_table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letter_table


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def suffix_automaton(symbols: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transitions (from, symbol, to) of the suffix automaton; states count from 1, which
    is the root."""
    length, link, follow, last = [0], [-1], [{}], 0
    for c in symbols:
        cur = len(length)
        length.append(length[last] + 1)
        link.append(0)
        follow.append({})
        p = last
        while p != -1 and c not in follow[p]:
            follow[p][c] = cur
            p = link[p]
        if p != -1:
            q = follow[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                follow.append(dict(follow[q]))
                while p != -1 and follow[p].get(c) == q:
                    follow[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    n = sum(map(len, follow))
    edges = np.fromiter((x for s, out in enumerate(follow) for c, t in out.items() for x in (s + 1, c, t + 1)), np.int64, 3 * n)
    return tuple(edges.reshape(n, 3).T)


class Edges:
    """(state, symbol) -> state, 0 where there is none. The rows of the transition table
    are laid over each other so that no two entries meet: a state's row begins at its
    base, and an entry there is its own if it bears the state's number."""

    def __init__(self, state: np.ndarray, symbol: np.ndarray, to: np.ndarray, symbols: int):
        order = np.lexsort((symbol, state))
        state, symbol, to = state[order], symbol[order], to[order]
        first = np.flatnonzero(np.diff(state, prepend=0))
        degree = np.diff(np.append(first, len(state)))
        self.base = np.zeros(int(max(state.max(initial=1), to.max(initial=1))) + 1, np.int64)
        used = bytearray(2 * len(state) + 2 * symbols + 1)
        rows, at, last = symbol.tolist(), symbols, 0
        for i in np.argsort(-degree, kind="stable").tolist():  # the fullest rows first
            row = rows[first[i] : first[i] + degree[i]]
            if degree[i] != last:
                at, last = symbols, int(degree[i])
            while True:
                at = used.find(0, at)
                if at < 0 or at + symbols >= len(used):
                    used += bytearray(len(used))
                    at = max(at, symbols)
                    at = used.find(0, at)
                begin = at - row[0]
                if not any(used[begin + c] for c in row):
                    break
                at += 1
            for c in row:
                used[begin + c] = 1
            self.base[state[first[i]]] = begin
        place = self.base[state] + symbol
        size = int(max(place.max(initial=0), self.base.max())) + symbols + 1
        self.owner, self.to = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.owner[place], self.to[place] = state, to

    def follow(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        at = self.base.take(state) + symbol
        return np.where(self.owner.take(at) == state, self.to.take(at), 0)


class Model:
    """The automaton of one language: edges, the root's own, and the length's logarithm."""

    def __init__(self, train: list[int], symbols: int):
        state, symbol, to = suffix_automaton(train)
        self.edges = Edges(state, symbol, to, symbols)
        self.root = np.zeros(symbols, np.int64)
        self.root[symbol[state == 1]] = to[state == 1]
        self.bits = math.log2(max(2, len(train)))


class Languages:
    """Automata of all languages, built from {language: [training texts]}."""

    def __init__(self, texts: dict[str, list[str]]):
        self.names = sorted(texts)
        is_letter = _letters()
        points = {name: [code_points(t) for t in texts[name]] for name in self.names}
        used = [np.unique(p) for parts in points.values() for p in parts]
        letters = np.unique(np.concatenate(used)) if used else np.zeros(0, np.uint32)
        letters = letters[is_letter[letters]]
        self.symbol = np.full(0x110000, _UNKNOWN, np.int64)
        self.symbol[letters] = 2 + np.arange(len(letters))
        self.pad = 2 + len(letters)  # also what divides training texts: no document has it
        self.models = [
            Model([x for p in points[name] for x in (*self._symbols(p)[0].tolist(), self.pad)], self.pad + 1) for name in self.names
        ]

    def _symbols(self, points: np.ndarray, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols with runs of gaps made one (not across ``starts``), the flags of
        what was kept, and of letters."""
        letter = _letters()[points]
        before = np.empty(len(points), bool)
        before[1:] = letter[:-1]
        if len(points):
            before[0] = True
        if starts is not None:
            before[starts[starts < len(points)]] = True
        keep = letter | before
        return np.where(letter[keep], self.symbol[points[keep]], _GAP), keep, letter

    def parse(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(documents, languages) normalised phrases, and whether each has a letter."""
        points = [code_points(t) for t in texts]
        sizes = np.array([len(p) for p in points], np.int64)
        ends = np.cumsum(sizes)
        symbols, keep, letter = self._symbols(np.concatenate(points) if points else np.zeros(0, np.uint32), ends - sizes)
        kept = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], ends])]
        lettered = np.diff(np.concatenate([[0], np.cumsum(letter)])[np.concatenate([[0], ends])]) > 0
        n = np.diff(kept)
        per_doc = -(-n // WINDOW)
        doc = np.repeat(np.arange(len(texts)), per_doc)
        first = np.concatenate([[0], np.cumsum(per_doc)])
        start = kept[doc] + (np.arange(len(doc)) - first[doc]) * WINDOW
        stop = kept[doc + 1]
        phrases = np.zeros((len(texts), len(self.names)))
        steps = np.arange(WINDOW)[:, None]
        for i in range(0, len(doc), 4096):
            at = start[i : i + 4096] + steps
            inside = at < stop[i : i + 4096]
            grid = np.where(inside, symbols[np.minimum(at, len(symbols) - 1)], self.pad)
            for m, model in enumerate(self.models):
                begin = model.root[grid]  # 0: a symbol that the language's texts lack
                lacks = inside & (begin == 0)
                begin[begin == 0] = 1
                count = 1 + np.count_nonzero(lacks, axis=0)
                state = np.ones(grid.shape[1], np.int64)
                for t in range(WINDOW):
                    if not inside[t].any():
                        break
                    to = model.edges.follow(state, grid[t])
                    dead = (to == 0) & inside[t]
                    count += dead
                    state = np.where(dead, begin[t], np.where(inside[t], to, state))
                phrases[:, m] += np.bincount(doc[i : i + 4096], count, len(texts))
        bits = np.array([m.bits for m in self.models])
        return phrases * bits / np.maximum(n, 1)[:, None], lettered

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score: 1 less the ratio of the best to the second best."""
        if not self.names or not texts:
            return [UNKNOWN_LANGUAGE] * len(texts), np.zeros(len(texts))
        h, lettered = self.parse(texts)
        best = h.argmin(axis=1)
        if len(self.names) > 1:
            low, second = np.partition(h, 1, axis=1)[:, :2].T
            score = 1 - low / np.where(second > 0, second, 1)
        else:
            score = np.ones(len(texts))
        return [self.names[b] if ok else UNKNOWN_LANGUAGE for b, ok in zip(best, lettered)], np.where(lettered, np.clip(score, 0, 1), 0.0)


def training_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", docs_per_language: int = DOCS_PER_LANGUAGE,
                   language_chars: int = LANGUAGE_CHARS, doc_chars: int = DOC_CHARS) -> dict[str, list[str]]:
    """For each language whole texts in the order of a hash of id and text, as long as
    they are ``docs_per_language`` at most with ``language_chars`` characters at most in
    all; texts of over ``doc_chars`` are passed over."""
    h = F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(1 << 40))
    usable = docs.where(F.col(lang).isNotNull() & F.length(F.col(text)).between(1, doc_chars)).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), h.alias("h"))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    bound = F.lit(0)
    for name, n in counts.items():
        bound = F.when(F.col("lang") == name, F.lit(int((1 << 40) * min(1.0, 4 * docs_per_language / n)))).otherwise(bound)
    # rows that repeat count once
    some = usable.where(F.col("h") < bound).dropDuplicates(["lang", "h"])
    first = Window.partitionBy("lang").orderBy("h")
    ranked = some.withColumns({"rank": F.row_number().over(first), "chars": F.sum(F.length("text")).over(first)})
    out: dict[str, list[str]] = {}
    for r in ranked.where((F.col("rank") <= docs_per_language) & (F.col("chars") <= language_chars)).orderBy("lang", "rank").collect():
        out.setdefault(r["lang"], []).append(r["text"])
    return out


def languages(texts: dict[str, list[str]]) -> Languages:
    """The model of these texts, built once in each Python process."""
    key = hashlib.sha256(repr(sorted(texts.items())).encode("utf-8", "surrogatepass")).hexdigest()
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Languages(texts)
    return _MODELS[key]


def held_out(doc_id: Column, parts: int = 5, part: int = 0) -> Column:
    """Whether crc32 of the id as text leaves ``part``; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(True))


def identify(docs: DataFrame, texts: dict[str, list[str]], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row, from the whole text alone.

    ``und`` with score 0 for a null text, a text without a letter, or if no language
    was learned. Equal texts get equal results; an empty table an empty one; other
    columns aren't read.
    """
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(texts)
    src = docs.select(docs[doc_id].alias("_id"), docs[text].alias("_text"))
    schema = T.StructType([src.schema["_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            model = languages(shared.value)
            for part in blocks(batch, "_text", 1 << 20):
                pred, score = model.predict(part.column("_text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(pred, pa.string()), pa.array(score)], names=schema.names)

    return src.mapInArrow(run, schema).withColumnRenamed("_id", doc_id)
