import random
import re

import numpy as np
import pyarrow as pa

from tillroll.llm import arrays as A
from tillroll.llm import features

TEXTS = ["a b a b a b c", None, "", "x", "x\x0by\x0cz", "  lead and trail \n", "é à é à é", "漢字 漢字 漢字 漢字", "a" * 600_000 + " b c " + "a" * 600_000, "one\ntwo\none\n \none"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


def test_words_and_hashes_agree_with_a_regular_expression():
    raw, offsets = A.utf8(pa.array(TEXTS))
    starts, ends, first = A.words(raw, offsets)
    found = [raw[s:e].tobytes().decode() for s, e in zip(starts, ends)]
    assert found == [w for t in TEXTS for w in words(t)]
    assert np.diff(first).tolist() == [len(words(t)) for t in TEXTS]
    h = A.span_hash(raw, starts, ends)
    by_word = {}
    for w, x in zip(found, h.tolist()):
        assert by_word.setdefault(w, x) == x
    assert len(set(by_word.values())) == len(by_word)


def test_hash_of_a_span_does_not_depend_on_its_block():
    text = ["ab " * 200_000]
    raw, offsets = A.utf8(pa.array(text))
    starts, ends, _ = A.words(raw, offsets)
    assert len(np.unique(A.span_hash(raw, starts, ends))) == 1


def test_shingles_are_sets_of_windows_or_the_whole_short_sequence():
    raw, offsets = A.utf8(pa.array(TEXTS))
    for k in (1, 2, 3, 5):
        sizes = [len(s) for s in A.shingles(raw, offsets, k)]
        for t, n in zip(TEXTS, sizes):
            w = words(t)
            want = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
            assert n == len(want)


def test_slices_of_an_array_are_read_from_their_own_offset():
    whole = pa.array(["skip this", "a b", None, "c"])
    raw, offsets = A.utf8(whole.slice(1))
    assert raw.tobytes() == b"a bc" and offsets.tolist() == [0, 3, 3, 4]


def test_blocks_hold_every_row_once():
    batch = pa.RecordBatch.from_pydict({"t": ["x" * 100, None, "y" * 5000, "z"], "i": [1, 2, 3, 4]})
    parts = list(A.blocks(batch, "t", 150))
    assert [i for p in parts for i in p.column("i").to_pylist()] == [1, 2, 3, 4]


def brute(t):
    t = t or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    twice = {i for i, g in enumerate(tri) if tri.count(g) > 1}
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t), "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len({i + j for i in twice for j in range(3)}),
        "n_distinct_words": len(set(w)), "n_upper": sum("A" <= c <= "Z" for c in t), "n_bangs": sum(c in "!?" for c in t),
        "n_stops": sum(x.endswith(".") for x in w), "n_bytes": len(t.encode()),
    }


def test_features_agree_with_brute_force():
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choices("ab.#!A \n\té", k=rng.randint(0, 80))) for _ in range(300)]
    got = features.count(*A.utf8(pa.array(texts)))
    for i, t in enumerate(texts):
        if t and len(t) > 10_000:
            continue
        for name, want in brute(t).items():
            assert got[name][i] == want, (name, t)
