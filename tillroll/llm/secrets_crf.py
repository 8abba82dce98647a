"""Secret scan: fixed patterns, and a linear-chain conditional random field.

Tokens are runs of [A-Za-z0-9+/_-]; any other character ends one. A chain over the
tokens of a text carries the tags outside, begin and inside. Tokens that can't be part
of a secret are fixed to outside: those of under 8 characters, and those of letters
alone unless capitals stand within them or a sign of an assignment or a quote stands
right before (white space aside). So the best path falls apart into the short runs of
candidate tokens between them: Viterbi decodes those, in lockstep, and the result is
that of the whole chain. A token's features are its shape, the words before and after,
the signs between them and features of the file; a span joins a begin with the insides
that follow.

The field is trained here, on a bounded sample of distinct texts, with the spans of
the patterns as weak labels (digit-only runs are labelled outside: they are numbers).
The patterns know few words and few shapes. So that the field learns what is around
and in a secret rather than those, each labelled token is also shown in ``variants``: in
its place random values of other alphabets, behind other signs of assignment, still
a secret; and plain words and words with a number there, no secret. Each run is also
shown with the words before its tokens taken away. What the patterns find always
stays; the field adds spans that touch none of them.
"""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import arrays as A
from tillroll.llm.scratch import ready, written

KINDS = ("assign", "access", "hex", "crf")
#: fixed values: the base patterns and their shortest matches
ASSIGN = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}

#: bounds of the training sample: distinct texts, runs of candidate tokens in all, and
#: tokens of a run (longer ones are cut, in training only)
TRAIN_DOCS, TRAIN_RUNS, TRAIN_TOKENS = 20_000, 200_000, 32
LEAST_TOKEN = 8
_SLOTS = 1 << 16
_EPOCHS = 40
_OUT, _BEGIN, _INSIDE = 0, 1, 2


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_DIGIT = _flags(b"0123456789")
_HEX = _flags(b"0123456789abcdef")
_TOKEN = _flags(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
_CAPITAL = _flags(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_SMALL = _flags(b"abcdefghijklmnopqrstuvwxyz")
_LEADS = _flags(b"=:\"'")


def base_spans(text: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes of the pattern matches, leftmost and
    non-overlapping per kind, without those that are too short."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    raw = np.frombuffer(text, np.uint8)
    starts, ends, _ = A.spans(_HEX[raw], np.array([0, len(raw)]))
    long_ = ends - starts >= LEAST["hex"]
    return out + [(int(s), int(e), "hex") for s, e in zip(starts[long_], ends[long_])]


def _bucket(value: float, cuts: tuple) -> int:
    return sum(value >= c for c in cuts)


def _shape(token: bytes) -> tuple:
    lower = sum(97 <= b <= 122 for b in token)
    upper = sum(65 <= b <= 90 for b in token)
    digit = sum(48 <= b <= 57 for b in token)
    kinds = [0 if 48 <= b <= 57 else 1 if b >= 97 else 2 if 65 <= b <= 90 else 3 for b in token]
    turns = sum(a != b for a, b in zip(kinds, kinds[1:])) / len(token)
    size = _bucket(len(token), (10, 12, 14, 16, 17, 20, 24, 32, 36, 40, 41, 64))
    return (size, bool(lower), bool(upper), lower + upper + digit < len(token), _bucket(digit / len(token), (0.1, 0.3, 0.5, 0.75, 1.0)),
            _bucket(turns, (0.05, 0.15, 0.3, 0.45, 0.6)), _bucket(len(set(token)) / min(len(token), 24), (0.2, 0.4, 0.6, 0.8)))


def _file_features(text: bytes) -> tuple:
    n = max(1, len(text))
    raw = np.frombuffer(text, np.uint8)
    signs = np.count_nonzero((raw > 32) & (raw < 128) & ~_TOKEN[raw])
    return (_bucket(n, (300, 3000, 30000)), _bucket(np.count_nonzero(_DIGIT[raw]) / n, (0.005, 0.02, 0.1)), _bucket(signs / n, (0.03, 0.1, 0.3)))


def _slot(*parts) -> int:
    return zlib.crc32(repr(parts).encode()) % _SLOTS


class Chain:
    """The runs of candidate tokens of one text: byte spans and feature slots. ``file``:
    features of the file, if the text is a part of one."""

    def __init__(self, text: bytes, words: tuple[np.ndarray, np.ndarray], file: tuple | None = None):
        starts, ends = words
        raw = np.frombuffer(text, np.uint8)
        self.runs: list[list[int]] = []
        self.start, self.end = starts, ends
        self.slots: dict[int, list[int]] = {}
        long_ = np.flatnonzero(ends - starts >= LEAST_TOKEN)
        if not len(long_):
            return
        s, e = starts[long_], ends[long_]

        def holds(flags: np.ndarray, begin: np.ndarray) -> np.ndarray:
            at = np.flatnonzero(flags[raw])
            return np.searchsorted(at, e) > np.searchsorted(at, begin)

        solid = np.flatnonzero(~A.SPACE[raw])
        before = np.searchsorted(solid, s) - 1
        led = (before >= 0) & _LEADS[raw[solid[np.maximum(before, 0)]]]
        mixed = holds(_CAPITAL, s + 1) & holds(_SMALL, s)
        for i in long_[holds(_DIGIT, s) | mixed | led].tolist():
            token = text[starts[i] : ends[i]]
            file = file or _file_features(text)
            self.slots[i] = self._slots(text, i, token, file)
            if self.runs and self.runs[-1][-1] == i - 1:
                self.runs[-1].append(i)
            else:
                self.runs.append([i])

    def _word(self, text: bytes, i: int) -> bytes:
        if not 0 <= i < len(self.start):
            return b""
        return text[self.start[i] : min(self.end[i], self.start[i] + 24)].lower()

    def _slots(self, text: bytes, i: int, token: bytes, file: tuple) -> list[int]:
        s, e = int(self.start[i]), int(self.end[i])
        before = text[int(self.end[i - 1]) if i else 0 : s][-6:]
        after = text[e : e + 2]
        shape = _shape(token)
        hex_ = all(_HEX[b] for b in token)
        one, two, nxt = self._word(text, i - 1), self._word(text, i - 2), self._word(text, i + 1)
        lead = (b"=" in before, b":" in before, any(q in before for q in (b'"', b"'")), b" " in before.strip() or b"\n" in before, after[:1] in (b'"', b"'"))
        return [_slot("bias"), _slot("shape", shape), _slot("size", shape[0], hex_), _slot("digits", shape[4], shape[5]),
                _slot("head", token[:4]), _slot("before", before), _slot("after", after), _slot("word-1", one), _slot("word-2", two),
                _slot("word+1", nxt), _slot("word-1 before", one, before), _slot("file", file), _slot("file hex", file, hex_),
                _slot("lead", lead), _slot("lead shape", lead, shape[1:])]


def _chains(part: pa.RecordBatch, column: str):
    """(text, chain) of each row of a block."""
    raw, offsets = A.utf8(part.column(column))
    starts, ends, first = A.spans(_TOKEN[raw], offsets)
    data = raw.tobytes()
    for i in range(len(offsets) - 1):
        a, b = int(offsets[i]), int(offsets[i + 1])
        yield data[a:b], Chain(data[a:b], (starts[first[i] : first[i + 1]] - a, ends[first[i] : first[i + 1]] - a))


def weak_tags(text: bytes, chain: Chain) -> dict[int, int]:
    """Tags of the candidate tokens from the pattern spans."""
    spans = []
    for s, e, kind in base_spans(text):
        if kind == "assign":
            s = e - len(ASSIGN.match(text, s)[2])
        spans.append((s, e))
    tags = {}
    for run in chain.runs:
        before = None
        for i in run:
            a, b = int(chain.start[i]), int(chain.end[i])
            own = next((x for x in spans if x[0] < b and a < x[1]), None)
            if own is None or text[a:b].isdigit():
                tags[i], before = _OUT, None
            else:
                tags[i], before = (_INSIDE if own == before else _BEGIN), own
    return tags


class Field:
    """Weights of (slot, tag) and of tag pairs; outside to inside is impossible."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move

    @classmethod
    def fit(cls, runs: list[tuple[list[list[int]], list[int]]]) -> "Field":
        """Maximum likelihood with Adagrad and a small ridge, over runs of
        (slots of each token, tags), batched by length."""
        emit, move = np.zeros((_SLOTS, 3)), np.zeros((3, 3))
        emit[_slot("bias")] = (1.0, -1.0, -1.0)
        sq_e, sq_m = np.full((_SLOTS, 3), 1e-3), np.full((3, 3), 1e-3)
        by_length: dict[int, list] = {}
        for slots, tags in runs:
            by_length.setdefault(len(tags), []).append((slots, tags))
        batches = [(np.array([s for s, _ in group]), np.array([t for _, t in group])) for _, group in sorted(by_length.items())]
        for _ in range(_EPOCHS if runs else 0):
            for slots, tags in batches:
                for i in range(0, len(tags), 4096):
                    ge, gm, used = cls._gradient(emit, move, slots[i : i + 4096], tags[i : i + 4096])
                    ge += 1e-3 * emit[used]
                    sq_e[used] += ge**2
                    emit[used] -= 0.3 * ge / np.sqrt(sq_e[used])
                    sq_m += gm**2
                    move -= 0.1 * gm / np.sqrt(sq_m)
        return cls(emit, move)

    @staticmethod
    def _moves(move: np.ndarray) -> np.ndarray:
        out = move.copy()
        out[_OUT, _INSIDE] = -1e9
        return out

    @classmethod
    def _gradient(cls, emit, move, slots, tags):
        """Of the negative log likelihood: expected less observed counts."""
        m = cls._moves(move)
        score = emit[slots].sum(axis=2)  # (runs, tokens, tags)
        r, n, _ = score.shape

        def lse(x, axis):
            top = x.max(axis=axis, keepdims=True)
            return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

        ahead = np.empty((r, n, 3))
        ahead[:, 0] = score[:, 0] + m[_OUT]
        for t in range(1, n):
            ahead[:, t] = score[:, t] + lse(ahead[:, t - 1, :, None] + m, 1)
        back = np.empty((r, n, 3))
        back[:, -1] = m[:, _OUT]
        for t in range(n - 2, -1, -1):
            back[:, t] = lse(m + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        total = lse(ahead[:, -1] + back[:, -1], 1)
        prob = np.exp(ahead + back - total[:, None, None])
        diff = prob.copy()
        np.subtract.at(diff, (np.arange(r)[:, None], np.arange(n), tags), 1)
        gm = np.zeros((3, 3))
        gm[_OUT] += diff[:, 0].sum(axis=0)
        gm[:, _OUT] += diff[:, -1].sum(axis=0)
        for t in range(1, n):
            pair = np.exp(ahead[:, t - 1, :, None] + m + (score[:, t] + back[:, t])[:, None, :] - total[:, None, None])
            gm += pair.sum(axis=0)
            np.subtract.at(gm, (tags[:, t - 1], tags[:, t]), 1)
        used, place = np.unique(slots, return_inverse=True)
        place = place.reshape(slots.shape)
        ge = np.column_stack([np.bincount(place.ravel(), np.repeat(diff[:, :, k].ravel(), slots.shape[2]), len(used)) for k in range(3)])
        return ge, gm, used

    def decode(self, slots: np.ndarray) -> np.ndarray:
        """Viterbi: the best tags of runs of one length (runs, tokens, slots)."""
        m = self._moves(self.move)
        score = self.emit[slots].sum(axis=2)
        best, came = score[:, 0] + m[_OUT], []
        for t in range(1, score.shape[1]):
            step = best[:, :, None] + m
            came.append(step.argmax(axis=1))
            best = step.max(axis=1) + score[:, t]
        tags = [(best + m[:, _OUT]).argmax(axis=1)]
        for c in reversed(came):
            tags.append(c[np.arange(len(c)), tags[-1]])
        return np.stack(tags[::-1], axis=1)


def field_spans(field: Field, chains: list[Chain]) -> list[list[tuple[int, int]]]:
    """Byte spans of the secrets in each chain."""
    by_length: dict[int, list] = {}
    for c, chain in enumerate(chains):
        for run in chain.runs:
            by_length.setdefault(len(run), []).append((c, run))
    out: list[list[tuple[int, int]]] = [[] for _ in chains]
    for group in by_length.values():
        for i in range(0, len(group), 4096):
            part = group[i : i + 4096]
            tags = field.decode(np.array([[chains[c].slots[t] for t in run] for c, run in part]))
            for (c, run), row in zip(part, tags):
                chain, open_ = chains[c], None
                for token, tag in zip(run, row):
                    if tag == _INSIDE and open_ is not None:
                        out[c][-1] = (open_, int(chain.end[token]))
                    elif tag == _BEGIN:
                        open_ = int(chain.start[token])
                        out[c].append((open_, int(chain.end[token])))
                    else:
                        open_ = None
    return [sorted(x) for x in out]


_LETTERS = b"abcdefghijklmnopqrstuvwxyz"
_ALPHABETS = (b"0123456789abcdef", _LETTERS + _LETTERS.upper() + b"0123456789", _LETTERS + _LETTERS.upper(),
              _LETTERS + _LETTERS.upper() + b"0123456789+/_-", _LETTERS.upper() + b"0123456789")
_SIGNS = (b' = "', b'="', b': "', b" = '", b"='", b": ", b" = ", b"=", b":")


def variants(text: bytes, chain: Chain, tags: dict[int, int]) -> list[tuple[list, list]]:
    """Runs (slots, tags) with other values in the place of each secret of one token:
    of every alphabet behind a sign (a secret), and words and words with a number,
    behind a sign or a blank (none). What is drawn depends on the text alone."""
    out = []
    file = _file_features(text)
    words = [w for w in re.findall(rb"[A-Za-z]{5,20}", text) if not w.isupper()] or [b"ordinary"]
    for i, tag in tags.items():
        if tag != _BEGIN or tags.get(i + 1) == _INSIDE:
            continue
        rng = random.Random(zlib.crc32(text[max(0, int(chain.start[i]) - 40) : int(chain.end[i])]))
        s, e = int(chain.end[i - 1]) if i else 0, int(chain.end[i])
        tail = text[e : e + 80].lstrip(b"\"'")
        values = [(bytes(rng.choices(a, k=rng.randint(14, 44))), rng.choice(_SIGNS), _BEGIN) for a in _ALPHABETS for _ in range(5)]
        for _ in range(6):
            word = rng.choice(words)
            values += [(word.lower() + rng.choice(words).lower()[:3], rng.choice(_SIGNS), _OUT), (word + b"%d" % rng.randint(0, 9999), b" ", _OUT),
                       (word + b"-" + rng.choice(words).title(), b" ", _OUT), (b"%d-%d" % (rng.randint(10, 9999), rng.randint(1000, 999999)), b" ", _OUT),
                       (word.title() + rng.choice(words).title(), b" ", _OUT)]
        for value, sign, own in values:
            head = text[max(0, s - 120) : s] + sign
            part = head + value + (sign[-1:] if sign[-1:] in b"\"'" else b"") + tail
            raw = np.frombuffer(part, np.uint8)
            starts, ends, _ = A.spans(_TOKEN[raw], np.array([0, len(raw)]))
            new = Chain(part, (starts, ends), file)
            for r in new.runs:
                if any(starts[t] == len(head) for t in r):
                    out.append(([new.slots[t] for t in r], [own if starts[t] == len(head) else _OUT for t in r]))
    return out


#: places of the slots of the words before a token, and what stands there without one
_WORD_SLOTS = (7, 8, 10)


def without_words(slots: list[int]) -> list[int]:
    """A token's slots as if no word stood before it."""
    return [_slot("no word", i) if i in _WORD_SLOTS else x for i, x in enumerate(slots)]


def training_runs(docs: DataFrame, text: str = "text", most: int = TRAIN_DOCS, most_runs: int = TRAIN_RUNS) -> list:
    """Candidate runs with weak tags of ``most`` distinct texts at most, the first by a
    hash of the text, and of their runs about ``most_runs`` at most by a hash of the run.
    Copies of a text count once."""
    ready(docs.sparkSession)
    h = F.xxhash64(docs[text])
    hashes = docs.where(docs[text].isNotNull()).select(h.alias("h")).distinct()
    # twice as many as are wanted, so that few hashes are sorted; then an exact cut
    share = F.pmod(F.col("h"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, 2 * most / max(hashes.count(), 1)))
    chosen = hashes.where(share).orderBy(F.pmod(F.col("h"), F.lit(1 << 40)), "h").limit(most)
    some = (
        docs.where(docs[text].isNotNull()).select(docs[text].alias("_text"), h.alias("h"))
        .join(F.broadcast(chosen), "h", "left_semi").dropDuplicates(["h"])
    )
    schema = "slots array<array<int>>, tags array<int>"

    def run(batches):
        for batch in batches:
            for part in A.blocks(batch, "_text"):
                slots, tags = [], []
                for body, chain in _chains(part, "_text"):
                    tag = weak_tags(body, chain) if chain.runs else {}
                    for whole in chain.runs:
                        for i in range(0, len(whole), TRAIN_TOKENS):
                            r = whole[i : i + TRAIN_TOKENS]
                            slots.append([chain.slots[t] for t in r])
                            tags.append([tag[t] for t in r])
                            if tags[-1][0] == _INSIDE:  # cut within a secret
                                tags[-1][0] = _BEGIN
                    for more, own in variants(body, chain, tag):
                        slots.append(more)
                        tags.append(own)
                slots += [[without_words(x) for x in r] for r in slots]
                tags += tags
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots, pa.list_(pa.list_(pa.int32()))), pa.array(tags, pa.list_(pa.int32()))], names=["slots", "tags"])

    runs = written(some.select("_text").mapInArrow(run, schema), "training-runs")
    kept = F.pmod(F.xxhash64("slots", "tags"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, most_runs / max(runs.count(), 1)))
    return sorted((tuple(map(tuple, r["slots"])), tuple(r["tags"])) for r in runs.where(kept).collect())[: 2 * most_runs]


def train(docs: DataFrame, text: str = "text", most: int = TRAIN_DOCS) -> Field:
    return Field.fit(training_runs(docs, text, most))


def _points(text: bytes, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Byte spans as code point spans."""
    if not spans:
        return []
    lead = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [(int(lead[s]), int(lead[e]), k) for s, e, k in spans]


def find(docs: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, found) of every row; ``found`` is an array of (kind, start, end, secret),
    by start and then kind, in code points with the end exclusive.

    Null and empty texts have no spans; repeated rows give equal rows; an empty
    table gives an empty result; other columns aren't read.
    """
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((field.emit.astype(np.float32), field.move))
    src = docs.select(docs[doc_id].alias("_id"), docs[text].alias("_text"))
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                         T.StructField("end", T.IntegerType()), T.StructField("secret", T.StringType())])
    schema = T.StructType([src.schema["_id"], T.StructField("found", T.ArrayType(span))])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("secret", pa.string())]))

    def run(batches):
        model = Field(*shared.value)
        for batch in batches:
            for part in A.blocks(batch, "_text"):
                bodies, chains = zip(*_chains(part, "_text"))
                rows = []
                for body, more in zip(bodies, field_spans(model, list(chains))):
                    base = base_spans(body)
                    spans = base + [(s, e, "crf") for s, e in more if not any(s < y and x < e for x, y, _ in base)]
                    spans.sort(key=lambda x: (x[0], KINDS.index(x[2])))
                    rows.append([{"kind": k, "start": s, "end": e, "secret": body[a:b].decode()}
                                 for (s, e, k), (a, b, _) in zip(_points(body, spans), spans)])
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(rows, arrow)], names=schema.names)

    return src.mapInArrow(run, schema).withColumnRenamed("_id", doc_id)


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the hash of their spans, and all spans as text."""
    def shown(x):
        return F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))

    base = F.filter("found", lambda x: x["kind"] != "crf")

    def count(kind):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(doc_id, *[count(k) for k in KINDS[:3]],
                        F.sha2(F.array_join(F.transform(base, shown), ","), 256).alias("base_sha256"),
                        F.array_join(F.transform("found", shown), ",").alias("spans"), count("crf"))
