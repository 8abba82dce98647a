"""Every stage against a plain version on its own input."""

import re
from collections import Counter, defaultdict

import corpus_pipeline as P
from tests.llm.util import rows
from tests.llm.test_filters import _contained
from tests.llm.test_near_duplicates import _brute
from tests.llm.test_native import _check_shards, _water
from tillroll.llm.scratch import written

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark, docs, labels):
    columns = docs.columns
    names = [n for n, _ in P.STAGES]
    assert names == ["quality_rules", "near_dedup", "decontamination", "mixing", "sharding"]
    out = [docs]
    for _, stage in P.STAGES:
        out.append(written(stage(spark, out[-1], SF), "test-stage"))
    start, good, once, clean, mixed, sharded = out
    assert all(d.columns == columns for d in out[:-1])
    # quality: base rule of the contract; 200 documents prove no cutoff
    def base_ok(t):
        w = WORD.findall(t)
        tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        count = Counter(tri)
        return len(w) >= 50 and 100 * len({i + j for i, g in enumerate(tri) if count[g] > 1 for j in range(3)}) <= 50 * len(w)

    assert sorted(r["doc_id"] for r in good.collect()) == sorted(r["doc_id"] for r in start.collect() if base_ok(r["text"]))
    # near-duplicates: the smallest id of each component
    want = _brute([(r["doc_id"], r["text"]) for r in good.collect()], 5, 80)
    assert sorted(r["doc_id"] for r in once.collect()) == sorted(i for i, (_, c) in want.items() if i == c)
    # decontamination
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {i for i, _ in _contained([(r["doc_id"], r["text"]) for r in once.collect()], items)}
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(r["doc_id"] for r in once.collect() if r["doc_id"] not in leaked)
    # mixing: rows repeated whole, words near the targets
    assert set(rows(mixed)) <= set(rows(clean)) and max(rows(mixed).values()) <= 3
    size = {r["doc_id"]: len(WORD.findall(r["text"])) for r in clean.collect()}
    have, took, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in clean.collect():
        have[r["source"]] += size[r["doc_id"]]
        most[r["source"]] = max(most[r["source"]], size[r["doc_id"]])
    for r in mixed.collect():
        took[r["source"]] += size[r["doc_id"]]
    for s, target in _water(have).items():
        assert abs(took[s] - target) <= most[s]
    # sharding
    assert rows(sharded.select(columns)) == rows(mixed)
    _check_shards(sharded.collect(), 8)


def test_quality_stage_where_cutoffs_act(spark, tmp_path):
    """250 good labels, far fewer than a rule needs by itself."""
    out = [(i, " ".join(f"w{i}x{j}" + ("#" if i % 6 == 0 else "") for j in range(60)), "en", int(i % 6 != 0)) for i in range(300)]
    df = spark.createDataFrame(out, "doc_id long, text string, lang string, quality int")
    df.select("doc_id", "quality").write.parquet(f"{tmp_path}/labels.parquet")
    got = P.quality(spark, df.drop("quality"), str(tmp_path))
    assert sorted(r["doc_id"] for r in got.collect()) == [i for i, _, _, good in out if good]


def _staged(spark, docs, sf_dir):
    for _, stage in P.STAGES:
        docs = written(stage(spark, docs, sf_dir), "test-run")
    return docs


def test_run_equals_the_stages(spark, docs):
    got, want = rows(P.run(spark, SF)), rows(_staged(spark, docs, SF))
    assert got == want and sum(got.values()) > 0 and P.ORACLE_SQL is None


def test_odd_rows_and_empty_tables_through_all_stages(spark, odd_docs, no_docs, tmp_path):
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_path}/odd/{t}.parquet")
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{t}.parquet")
    out = _staged(spark, odd_docs, f"{tmp_path}/odd")
    assert out.columns[: len(odd_docs.columns)] == odd_docs.columns
    assert set(rows(out.select(odd_docs.columns))) <= set(rows(odd_docs))
    ids = {r["doc_id"] for r in out.collect()}
    assert not ids & {3, 4, 5, 6}  # no words, or too few of them
    odd_docs.write.parquet(f"{tmp_path}/odd/documents.parquet")
    assert rows(P.run(spark, f"{tmp_path}/odd")) == rows(out)
    no_docs.write.parquet(f"{tmp_path}/none/documents.parquet")
    assert P.run(spark, f"{tmp_path}/none").count() == 0
