import random

import numpy as np
import pytest

from tests.llm.util import rows, same_as_sql
from tillroll.llm import near_duplicates as N
from tillroll.llm.components import components
from tillroll.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_query_equals_its_sql(spark, tables):
    same_as_sql(QUERIES["op3_near_duplicates"](spark, SF), tables, ORACLE_SQL["op3_near_duplicates"])


def _brute(docs, k, percent):
    def sh(t):
        w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in (t or "").split()]
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())

    sets = [(i, sh(t)) for i, t in docs]
    parent = {i: i for i, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(i), find(j)))
                parent[q] = p
    return {i: (len(s), find(i)) for i, s in sets}


def _family(rng, vocabulary, start, size, change):
    """Copies of one text, each with some words changed: many lie near 0.8."""
    base = rng.choices(vocabulary, k=120)
    out = []
    for j in range(size):
        words = list(base)
        for at in rng.sample(range(120), rng.randint(0, change)):
            words[at] = rng.choice(vocabulary)
        out.append((start + j, " ".join(words)))
    return out


@pytest.mark.parametrize("k", [2, 5])
def test_components_equal_brute_force_around_the_threshold(spark, k):
    rng = random.Random(k)
    vocabulary = [f"w{i}" for i in range(3000)]
    docs = []
    for f in range(12):
        docs += _family(rng, vocabulary, f * 100, 25, 4 if k == 5 else 9)
    chain = rng.choices(vocabulary, k=200)
    for j in range(12):  # neighbours are linked, the ends are not
        docs.append((5000 + j, " ".join(chain[j * 8 : j * 8 + 100])))
    docs += [(9000, None), (9001, ""), (9002, "one"), (9003, "ONE"), (9004, "two")]
    rng.shuffle(docs)
    want = _brute(docs, k, 80)
    got = N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=k).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_a_large_group_of_copies_costs_no_pairs_of_its_own(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(500)]
    docs = _family(rng, vocabulary, 0, 900, 3) + [(2000 + i, "same text of a few words") for i in range(900)]
    got = N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=2).collect()
    assert {r["component_id"] for r in got if r["doc_id"] < 900} == {0}
    assert {r["component_id"] for r in got if r["doc_id"] >= 2000} == {2000}


def test_a_row_repeated_thousands_of_times_is_one_node(spark):
    rng = random.Random(3)
    base = rng.choices([f"w{i}" for i in range(500)], k=100)
    near = [*base[:50], "other", *base[51:]]
    docs = [(1, " ".join(base))] * 4000 + [(2, " ".join(near))] * 4000
    got = N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=2).groupBy("doc_id", "component_id", "kept").count().collect()
    assert {(r["doc_id"], r["component_id"], r["kept"], r["count"]) for r in got} == {(1, 1, True, 4000), (2, 1, False, 4000)}


def test_sketches_estimate_and_never_exclude_a_link():
    rng = np.random.RandomState(4)
    for _ in range(60):
        n = rng.randint(5, 3000)
        common = rng.randint(0, 1 << 62, n).astype(np.uint64)
        extra = rng.randint(0, n // 8 + 1)
        x = np.unique(np.concatenate([common, rng.randint(0, 1 << 62, extra).astype(np.uint64)]))
        y = np.unique(np.concatenate([common, rng.randint(0, 1 << 62, extra).astype(np.uint64)]))
        inter = len(np.intersect1d(x, y))
        j = inter / (len(x) + len(y) - inter)
        sig = np.stack([N.signature(x), N.signature(y)])
        assert abs((sig[0] == sig[1]).mean() - j) < 0.2
        both = np.concatenate([N.odd_sketches(sig), np.stack([N.set_sketch(x), N.set_sketch(y)])], axis=1)
        flips = np.bitwise_count(both[0, 8:] ^ both[1, 8:]).sum()
        assert flips <= len(x) + len(y) - 2 * inter
        if j >= 0.8:
            assert N.possible(len(x), both[0], len(y), both[1], 80)
            assert (N.band_keys(sig)[0] == N.band_keys(sig)[1]).any()


def test_connected_components(spark):
    rng = random.Random(6)
    links = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {x: x for l in links for x in l}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        p, q = sorted((find(a), find(b)))
        parent[q] = p
    assert all(got.get(x, x) == find(x) for x in parent)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edge_cases(spark, odd_docs, no_docs):
    found = N.near_duplicates(odd_docs, k=2).collect()
    assert len(found) == odd_docs.count()
    by = {r["doc_id"]: r for r in found}
    assert by[3]["n_shingles"] == by[4]["n_shingles"] == by[6]["n_shingles"] == 0 and by[3]["kept"]
    assert by[2]["component_id"] == 1 and by[9]["component_id"] == 1 and by[8]["component_id"] == 7
    assert by[None]["component_id"] is None and by[None]["kept"]
    assert N.near_duplicates(no_docs, k=2).count() == 0
    once = N.deduplicate(odd_docs)
    assert once.columns == odd_docs.columns and rows(once) <= rows(odd_docs)
    ids = [r["doc_id"] for r in once.collect()]
    assert sorted(i for i in ids if i) == [1, 3, 4, 5, 6, 7, 10, 11] and None in ids
    assert N.deduplicate(no_docs).count() == 0
