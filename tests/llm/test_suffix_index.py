import random

import numpy as np
import pytest

from tests.llm.util import same_as_sql
from tillroll.llm import queries
from tillroll.llm import suffix_index as S

SCHEMA = "doc_id long, text string, spans int, kept string"


def brute(rows):
    """(id, bytes, removed, spans, kept) of every row, from a table of all strings."""
    first: dict[bytes, int] = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, b in texts:
        for p in range(len(b) - 49) if i is not None else ():
            s = b[p : p + 50]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, b in texts:
        gone = np.zeros(len(b) + 1, np.int64)
        for p in range(len(b) - 49) if i is not None else ():
            if first[b[p : p + 50]] < i:
                gone[p : p + 50] = 1
        edge = np.flatnonzero(np.diff(gone, prepend=0)).tolist()
        spans = list(zip(edge[::2], edge[1::2]))
        out.append((i, len(b), int(gone.sum()), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in S.remove_repeats(df).collect()), key=str)


def mixed_rows(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(2, 7))) for _ in range(60)]
    passages = [" ".join(rng.choices(words, k=rng.randint(8, 60))) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.3 else " ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(rng.randint(1, 6))]
        rows.append((rng.randint(1, 90), rng.choice(["", " ", "\n"]).join(parts)))
    rows += [(200, None), (201, ""), (202, "short"), (None, passages[0]), (None, passages[0] * 3), (3, passages[1]), (3, passages[1])]
    rows += [(300, "ab" * 400), (301, "ab" * 90), (302, "a" * 300), (303, "a" * 49), (304, "a" * 50), (305, "b" + "a" * 50 + "c")]
    rows += [(310, "x" * 20 + "y" * 29), (311, "\x00" * 120), (312, "\x00" * 60 + "z"), (313, "漢字" * 60), (314, "字漢" * 60)]
    return rows


@pytest.mark.parametrize("seed, hot", [(1, 4096), (2, 4096), (3, 2)])
def test_equals_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(S, "most_contexts", lambda total, parts: hot)  # 2: nearly all mixed grams are dealt by window
    rows = mixed_rows(seed)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA).repartition(5)
    assert found(df) == brute(rows)


def test_a_text_longer_than_a_piece(spark):
    rng = random.Random(9)
    long = "".join(rng.choices("abcdefghij ", k=S._PIECE + 200_000))
    rows = [(1, long), (2, "0123456789" + long[150_000:] + "tail"), (3, long[S._PIECE - 100 : S._PIECE + 100])]
    got = {r.doc_id: r for r in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed == 0
    assert [(s.start, s.end) for s in got[2].spans] == [(10, len(rows[1][1]) - 4)] and bytes(got[2].kept) == b"0123456789tail"
    assert bytes(got[3].kept) == b""


def test_runs_cover_each_window_once(monkeypatch):
    monkeypatch.setattr(S, "_PIECE", 256)
    raw = np.random.RandomState(4).randint(97, 100, 3000).astype(np.uint8)
    offsets = np.array([0, 10, 900, 900, 949, 1000, 3000])
    seen = [w for row, start, count, *_ in S.runs(raw, offsets) for r, s, c in zip(row, start, count) for w in [(r, s + k) for k in range(c)]]
    want = [(r, p) for r in range(6) for p in range(offsets[r], offsets[r + 1] - 49)]
    assert sorted((int(r), int(p)) for r, p in seen) == [(r, int(p)) for r, p in want]
    for _, start, count, _, anchor in S.runs(raw, offsets):
        assert (start <= anchor).all() and (anchor < start + S.RUN).all() and (count <= S.RUN).all()


def test_leftmost_least():
    h = np.array([5, 3, 3, 9, 1, 1, 7, 0, 0, 2], np.uint64) << np.uint64(40)
    for width in (1, 3, 4, 9):
        assert S.leftmost_least(h, width).tolist() == [int(i + np.argmin(h[i : i + width])) for i in range(len(h) - width + 1)]


def test_family_levels_are_geometric_and_exact():
    rng = np.random.RandomState(6)
    family, first = S.IndexFamily(), {}
    for batch in range(40):
        docs = np.sort(rng.randint(batch * 5, batch * 5 + 8, 64)) if batch else np.zeros(64, np.int64)
        docs = np.maximum(docs, max(first.values(), default=0))
        raw = rng.randint(0, 3, (64, 50)).astype(np.uint8)
        raw[:, 6:] = 65
        windows = np.ascontiguousarray(raw).view("S50").ravel()
        for w, d in zip(windows, docs):
            first[bytes(w)] = min(first.get(bytes(w), int(d)), int(d))
        flags = family.add(windows, docs)
        assert flags.tolist() == [first[bytes(w)] < d for w, d in zip(windows, docs)]
        sizes = [len(x) for x, _ in family.levels]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))
    assert sum(len(x) for x, _ in family.levels) == len(first)


def test_a_gram_is_hot_beyond_a_fair_share():
    assert S.most_contexts(10, 8) == S.HOT and S.most_contexts(10**6, 100) == 10**4


def test_odd_rows_and_empty_table(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert found(odd_docs) == brute(rows)
    assert S.remove_repeats(no_docs).collect() == []


def test_query_equals_sql(spark, tables):
    same_as_sql(queries.QUERIES["op13_suffix_dedup"](spark, "/root/testdata/sf0.001"), tables, queries.ORACLE_SQL["op13_suffix_dedup"])
