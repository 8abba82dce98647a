import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.util import same_as_sql
from tillroll.llm import fill_in_middle as M
from tillroll.llm import queries


@pytest.mark.parametrize("offsets, kind", [
    (np.arange(0, 60_000, 97), M.ArrayContainer),
    (np.flatnonzero(np.random.RandomState(1).rand(65_536) < 0.5), M.BitmapContainer),
    (np.concatenate([np.arange(10, 9_000), np.arange(20_000, 50_000)]), M.RunContainer),
])
def test_containers_select(offsets, kind):
    found = M.BoundarySet(offsets)
    assert [type(c) for c in found.containers] == [kind]
    assert [found.select(k) for k in range(0, len(offsets), 7)] == offsets[::7].tolist()
    assert found.select(len(offsets) - 1) == offsets[-1]


def test_set_over_many_chunks():
    rng = np.random.RandomState(3)
    offsets = np.unique(np.concatenate([rng.randint(0, 300_000, 500), np.arange(70_000, 100_000), 131_072 + np.flatnonzero(rng.rand(65_536) < 0.4)]))
    found = M.BoundarySet(offsets)
    assert len(found) == len(offsets) and len({type(c) for c in found.containers}) == 3
    assert [found.select(k) for k in range(len(offsets))] == offsets.tolist()
    assert found.cut(0) == 0 and found.cut(3) == offsets[2] + 1
    assert len(M.BoundarySet(np.zeros(0, np.int64))) == 0


def plain(doc_id, text, fim, spm):
    t = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", t)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    d = [int(h[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or d[2] % 100 >= fim:
        return len(lines), "plain", None, None, t
    a, b = sorted(x % (len(lines) + 1) for x in d[:2])
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if d[3] % 100 < spm:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("fim, spm", [(100, 50), (60, 20)])
def test_equals_plain_cutting_and_restores(spark, odd_docs, fim, spm):
    more = spark.createDataFrame([
        (20 + i, t, None, None, 0, "", 0.0, False) for i, t in enumerate(
            ["\n", "\n\n\n", "a\n", "a\nb", "x<P>y\nz", "<S", "é\n漢字\n\U0001f600 tail", "\n" * 70_000 + "end", "<\nP>\n<M\n>", "a\r\nb\r\n"])
    ], odd_docs.schema)
    docs = odd_docs.unionByName(more)
    got = M.fill_in_middle(docs, fim_percent=fim, spm_percent=spm).withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
    rows = docs.select("doc_id", "text").collect()
    assert sorted(map(str, [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in got])) == sorted(
        map(str, [(r.doc_id, *plain(r.doc_id, r.text, fim, spm), r.text or "") for r in rows]))
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table(no_docs):
    assert M.fill_in_middle(no_docs).collect() == []


def test_query_equals_sql(spark, tables):
    same_as_sql(queries.QUERIES["op12_fill_in_middle"](spark, "/root/testdata/sf0.001"), tables, queries.ORACLE_SQL["op12_fill_in_middle"])
