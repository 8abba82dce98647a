"""Quality rules, quality model, language id, decontamination."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.util import rows, same_as_sql
from tillroll.llm import decontamination, language_id, oracle, quality_model, quality_rules
from tillroll.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op2_decontamination", "op5_quality_rules"])
def test_query_equals_its_sql(spark, tables, name):
    same_as_sql(QUERIES[name](spark, SF), tables, ORACLE_SQL[name])


def _labelled(spark, n=4000):
    """Documents of two languages; bad ones have many signs, few good ones do."""
    rng = random.Random(5)
    out = []
    for i in range(n):
        bad = i % 7 == 0
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randint(0, 999)) + ("$" if bad and rng.random() < 0.8 else "") for _ in range(60)]
        out.append((i, " ".join(words), "en" if i % 4 else "xx", int(not bad)))
    return spark.createDataFrame(out, "doc_id long, text string, lang string, quality int")


def test_cutoffs_reject_bad_documents_within_the_risk_and_equal_the_sql(spark, tmp_path):
    df = _labelled(spark).cache()
    judged = quality_rules.judge(df, df.select("doc_id", "quality"))
    pdf = judged.join(df.select("doc_id", "quality"), "doc_id").toPandas()
    assert (~pdf[pdf.quality == 0].kept).mean() > 0.9
    for _, part in pdf[pdf.quality == 1].groupby("lang"):
        assert (~part.kept).mean() <= quality_rules.RISK
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text", "lang").toPandas())
    con.register("labels", df.select("doc_id", "quality").toPandas())
    same_as_sql(judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules"),
                con, oracle.quality_rules())


def test_copies_of_one_document_prove_nothing(spark):
    rng = random.Random(8)
    text = " ".join(f"w{j}" for j in range(60))
    other = [(1000 + i, " ".join(f"x{rng.randint(0, 99999)}#" for _ in range(60)), "en", None) for i in range(10)]
    copies = [(1, text, "en", 1)] * 700 + [(2 + i, text, "en", 1) for i in range(300)]
    df = spark.createDataFrame(copies + other, "doc_id long, text string, lang string, quality int")
    labels = df.where("quality is not null").select("doc_id", "quality")
    judged = quality_rules.judge(df.drop("quality"), labels)
    assert judged.where("not kept").count() == 0  # one good text is no evidence
    assert quality_rules.keep_good(df.drop("quality"), labels).count() == df.count()


def test_judge_and_keep_good_decide_alike(spark):
    df = _labelled(spark, 700).cache()
    labels = df.select("doc_id", "quality")
    judged = quality_rules.judge(df.drop("quality"), labels)
    kept = quality_rules.keep_good(df.drop("quality"), labels)
    assert sorted(r["doc_id"] for r in judged.where("kept").collect()) == sorted(r["doc_id"] for r in kept.collect())
    assert judged.where("not base_failed and not kept").count() > 80


def test_too_few_labels_prove_nothing():
    grid = quality_rules.RULES
    none = {"stratum": "en", "n_good": 0} | {f"{r}_{i}": 0 for r, (_, _, g) in grid.items() for i in range(len(g))}
    assert all(c is None for _, _, c in quality_rules.proven_cutoffs([none], grid, 0.05, 0.05))


def test_binomial_tail_is_exact():
    from math import comb

    for n, k, p in [(10, 0, 0.1), (50, 7, 0.2), (300, 2, 0.01)]:
        want = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality_rules.binomial_tail(k, n, p) == pytest.approx(want, rel=1e-10)


def test_the_joint_path_needs_fewer_labels_and_single_rules_still_act(spark):
    """en: few labels, bad documents full of signs; xx: many labels, and most good documents break another rule."""
    rng = random.Random(6)
    out = []
    for i in range(3200):
        lang, bad = "en" if i < 200 else "xx", i % 7 == 0
        bang = lang == "xx" and rng.random() < 0.9
        words = [f"w{rng.randint(0, 99999)}" + ("$" if bad else "") + ("!!" if bang else "") for _ in range(60)]
        out.append((i, " ".join(words), lang, int(not bad)))
    df = spark.createDataFrame(out, "doc_id long, text string, lang string, quality int").cache()
    kept = quality_rules.keep_good(df.drop("quality"), df.select("doc_id", "quality"))
    pdf = df.toPandas()
    pdf["kept"] = pdf.doc_id.isin([r["doc_id"] for r in kept.collect()])
    assert not pdf[pdf.quality == 0].kept.any()
    assert pdf[pdf.quality == 1].kept.all()


def test_joint_cutoffs_hold_the_risk():
    grid = quality_rules.RULES
    steps = quality_rules.joint_path(grid)
    assert [list(g) for _, _, g in grid.values()] == [list(dict.fromkeys(s[r] for s in steps)) for r in grid]

    def proven(n, lost):
        row = {"stratum": "en", "n_good": n} | {f"joint_{i}": k for i, k in enumerate(lost)}
        return {c for _, _, c in quality_rules.proven_jointly([row], grid, 0.05, 0.025)}

    assert proven(71, [0] * 10) == {None} and None not in proven(72, [0] * 10)
    assert proven(200, [3] + [11] * 9) == set(steps[0].values())


def test_quality_edge_cases(spark, odd_docs, no_docs, labels):
    judged = {r["doc_id"]: r for r in quality_rules.judge(odd_docs, labels).collect()}
    assert judged[3]["n_words"] == judged[4]["n_words"] == judged[6]["n_words"] == 0
    assert judged[3]["base_failed"] and not judged[3]["kept"]
    kept = quality_rules.keep_good(odd_docs, labels)
    assert kept.columns == odd_docs.columns and rows(kept) <= rows(odd_docs)
    assert quality_rules.judge(no_docs, labels).count() == 0
    assert quality_rules.keep_good(no_docs, labels).count() == 0
    assert quality_rules.judge(odd_docs, labels.limit(0)).count() == odd_docs.count()


def test_quality_model_separates_held_out_documents(spark):
    df = _labelled(spark)
    learn = lambda c: ~language_id.held_out(c, 3, 1)
    pdf = quality_model.classify(df, df.select("doc_id", "quality"), learn).toPandas().merge(df.select("doc_id", "quality").toPandas(), on="doc_id")
    test = pdf[[zlib.crc32(str(i).encode()) % 3 == 1 for i in pdf.doc_id]]
    assert (test.predicted == test.quality).mean() > 0.97
    assert pdf.score.between(0, 1).all() and ((pdf.score >= 0.5) == (pdf.predicted == 1)).all()


def test_one_id_that_repeats_gives_one_training_row(spark):
    rows = [(1, f"copy {i % 40} of a text", 1) for i in range(3000)] + [(10 + i, f"text {i}", i % 2) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    from tillroll.llm.features import text_features

    features = text_features(df, ["doc_id"])
    every = lambda c: F.lit(True)
    x, y = quality_model.training_rows(features, df.select("doc_id", "quality").distinct(), every)
    assert x.shape == (51, len(quality_model.INPUTS)) and y.sum() == 26
    x, _ = quality_model.training_rows(features, df.select("doc_id", "quality").distinct(), every, most=20)
    assert len(x) == 20


def _plain_boosting(x, y, rounds):
    """Cyclic boosting of depth-2 trees over quantile bins, row by row, without pairs."""
    n = len(y)
    train = [i for i in range(n) if i % 5 != 4]
    base = np.log((sum(y) + 1) / (n - sum(y) + 1))
    f = [base] * n
    d = len(x[0])
    edges = [sorted(set(np.quantile([r[j] for r in x], np.arange(1, quality_model.BINS) / quality_model.BINS))) for j in range(d)]
    place = [[sum(v >= e for e in edges[j]) for v in (r[j] for r in x)] for j in range(d)]

    def split(rows, j, g, h, bins):
        total_g, total_h = sum(g[i] for i in rows), sum(h[i] for i in rows)
        best, at = 0.0, None
        for c in range(bins[0], bins[1] - 1):
            left = [i for i in rows if place[j][i] <= c]
            gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
            if hl < 0.5 or total_h - hl < 0.5:
                continue
            gain = gl**2 / (hl + 1) + (total_g - gl) ** 2 / (total_h - hl + 1) - total_g**2 / (total_h + 1)
            if gain > best + 1e-12:
                best, at = gain, c
        return at

    def grow(rows, j, g, h, bins, depth, leaf):
        at = split(rows, j, g, h, bins) if depth else None
        if at is None:
            value = sum(g[i] for i in rows) / (sum(h[i] for i in rows) + 1)
            for b in range(*bins):
                leaf[b] = value
            return
        grow([i for i in rows if place[j][i] <= at], j, g, h, (bins[0], at + 1), depth - 1, leaf)
        grow([i for i in rows if place[j][i] > at], j, g, h, (at + 1, bins[1]), depth - 1, leaf)

    for _ in range(rounds):
        for j in range(d):
            p = [1 / (1 + np.exp(-v)) for v in f]
            leaf = {}
            grow(train, j, [a - b for a, b in zip(y, p)], [b * (1 - b) for b in p], (0, len(edges[j]) + 1), 2, leaf)
            f = [v + quality_model.RATE * leaf[place[j][i]] for i, v in enumerate(f)]
    return f


def test_boosting_equals_a_plain_version(monkeypatch):
    rng = np.random.RandomState(4)
    x = np.round(rng.rand(120, 3), 2)
    y = ((x[:, 0] > 0.4) & (rng.rand(120) < 0.9)).astype(float)
    monkeypatch.setattr(quality_model, "ROUNDS", 6)
    monkeypatch.setattr(quality_model, "PAIRS", 0)
    model = quality_model.fit(x, y)
    # the number of rounds is where the held-back rows have their smallest loss
    test = np.arange(120) % 5 == 4

    def loss(f):
        p = np.clip(1 / (1 + np.exp(-np.array(f)[test])), 1e-9, 1 - 1e-9)
        return -np.mean(y[test] * np.log(p) + (1 - y[test]) * np.log(1 - p))

    paths = [_plain_boosting(x.tolist(), y.tolist(), r) for r in range(7)]
    best = 0
    for r in range(1, 7):
        if loss(paths[r]) < loss(paths[best]) - 1e-6:
            best = r
    assert best > 0 and np.allclose(model.margin(x), paths[best], atol=1e-9)


def test_registered_quality_query_scores_each_document_by_its_text(spark, docs):
    got = {r["doc_id"]: r for r in QUERIES["op9_quality_model"](spark, SF).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(got) == set(texts)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    by_text: dict = {}
    for i, t in texts.items():
        by_text.setdefault(t, set()).add(got[i]["score"])
    assert all(len(s) == 1 for s in by_text.values())
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(got[i]["predicted"], q) for i, q in quality.items() if i in got and got[i]["held_out"]]
    assert np.mean([a == b for a, b in held]) > 0.9


def test_pair_tables_learn_an_interaction():
    rng = np.random.RandomState(0)
    x = rng.rand(6000, 3)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_model.fit(x, y)
    assert (1, 0) in model.pairs
    assert ((model.score(x) >= 0.5) == (y == 1)).mean() > 0.9


def test_quality_model_edge_cases(spark, odd_docs, no_docs, labels):
    every = lambda c: F.lit(True)
    assert quality_model.classify(odd_docs, labels, every).count() == odd_docs.count()
    none = quality_model.classify(odd_docs, labels.limit(0), every).toPandas()
    assert (none.score == 0.5).all() and (none.predicted == 1).all()
    assert quality_model.classify(no_docs, labels, every).count() == 0


def test_language_of_held_out_documents(spark, docs):
    found = QUERIES["op1_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]).all()
    assert (found[found.held_out].lang_pred == found[found.held_out].lang).mean() > 0.9
    assert found.score.between(0, 1).all()


def test_greedy_parse_agrees_with_substring_search():
    text = "the quick brown fox jumps over the lazy dog and then the quick fox sleeps"
    model = language_id.Languages({"a": [text], "b": ["zzz yyy xxx"]})
    rng = random.Random(1)
    for _ in range(40):
        probe = "".join(rng.choices("thequickbrownfx zy", k=rng.randint(1, 60)))
        probe = " ".join(probe.split()) or "q"
        for m, train in enumerate(("the quick brown fox jumps over the lazy dog and then the quick fox sleeps", "zzz yyy xxx")):
            count, i = 0, 0
            while i < len(probe):
                j = i
                while j < len(probe) and probe[i : j + 1] in train:
                    j += 1
                count += 1 if j > i else 1
                i = max(j, i + 1)
            bits = model.models[m].bits
            got = model.parse([probe])[0][0, m] * len(probe) / bits
            assert abs(got - count) <= sum(c not in train for c in probe) + 1e-6


def test_language_edge_cases(spark, odd_docs, no_docs):
    texts = language_id.training_texts(odd_docs, doc_chars=1_000_000, language_chars=2_000_000)
    found = {r["doc_id"]: r for r in language_id.identify(odd_docs, texts).collect()}
    assert {found[i]["lang_pred"] for i in (3, 4, 6)} == {"und"} and found[3]["score"] == 0
    assert found[7]["lang_pred"] in ("en", "de")
    assert language_id.training_texts(no_docs) == {} and language_id.identify(no_docs, texts).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(odd_docs, {}).collect()} == {"und"}


def test_every_letter_counts_in_scripts_of_many_letters():
    """Texts of thousands of letters, of which two languages share all."""
    rng = random.Random(2)
    letters = [chr(0x4E00 + i) for i in range(3000)]

    def language(seed):
        follow = random.Random(seed)
        table = {c: follow.choices(letters, k=4) for c in letters}

        def text(n):
            c, out = rng.choice(letters), []
            for _ in range(n):
                out.append(c)
                c = rng.choice(table[c])
            return "".join(out)

        return text

    one, two = language(1), language(2)
    model = language_id.Languages({"one": [one(2000) for _ in range(10)], "two": [two(2000) for _ in range(10)]})
    names, score = model.predict([one(200) for _ in range(20)] + [two(200) for _ in range(20)])
    assert names == ["one"] * 20 + ["two"] * 20 and (score > 0.1).all()
    assert all(m.edges.to.nbytes < 3_000_000 for m in model.models)  # not states x letters


def test_training_texts_are_whole_and_bounded(spark):
    rows = [(i, f"word{i} " * (i % 50 + 1), "en" if i % 2 else "de") for i in range(400)] + [(1, "word1 " * 2, "en")] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.training_texts(df, language_chars=5000, doc_chars=300)
    known = {t for _, t, _ in rows}
    for texts in got.values():
        assert set(texts) <= known and len(set(texts)) == len(texts) and max(map(len, texts)) <= 300
        assert 2000 < sum(map(len, texts)) <= 5000


def _contained(docs, items, k=5, percent=80):
    import re

    def words(t):
        return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower())

    def sh(w, n):
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    ds, qs = [(i, words(t)) for i, t in docs], [(i, words(t)) for i, t in items]
    shingles = {n: [(i, sh(w, n)) for i, w in ds] for n in range(1, k + 1)}
    out = set()
    for q, w in qs:
        if w:  # an item of fewer than k words is one shingle of all its words
            y = sh(w, min(k, len(w)))
            out |= {(d, q) for d, x in shingles[min(k, len(w))] if 100 * len(x & y) >= percent * len(y)}
    return out


def test_decontamination_finds_partial_passages_and_nothing_else(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 60)))) for i in range(60)] + [(None, "one two three four five six"), (61, None), (62, "")]
    docs = []
    for i in range(200):
        body = rng.choices(vocabulary, k=rng.randint(0, 300))
        if i % 3:
            item = (items[rng.randrange(60)][1]).split()
            cut = rng.randint(0, max(0, len(item) // 3))
            body[len(body) // 2 : len(body) // 2] = [w.upper() + "," for w in item[cut:]]
        docs.append((i, " ".join(body)))
    docs += [(500, items[3][1]), (500, items[3][1]), (501, None), (502, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(items, "item_id long, text string")
    got = [(r["doc_id"], r["item_id"]) for r in decontamination.contained(d, q).collect()]
    assert len(got) == len(set(got)) and set(got) == _contained(docs, items)
    clean = decontamination.decontaminate(d, q)
    gone = {i for i, _ in got}
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(i for i, _ in docs if i not in gone)


def test_signature_always_meets_a_contained_item(spark):
    item = spark.createDataFrame([(1, " ".join(f"a{i}" for i in range(45)))], "item_id long, text string")
    sig = decontamination.item_shingles(item, "item_id", "text", 5, 80).toPandas()
    upper = 64
    assert sig._minimum.sum() == upper - -(-80 * upper // 100) + 1
    assert set(sig[sig._minimum]._h.astype("uint64")) == set(sorted(sig._h.astype("uint64"))[: sig._minimum.sum()])


def test_a_short_item_is_found_inside_a_long_document(spark):
    docs = [(1, "zero One, two three four five six seven eight nine ten"), (2, "one two three x four"), (3, "two three four five"), (4, "one")]
    items = [(1, "two three four five"), (2, "one"), (3, "three four"), (4, "four three")]
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.contained(d, q).collect()}
    assert got == {(1, 1), (3, 1), (1, 2), (2, 2), (4, 2), (1, 3), (3, 3)} == _contained(docs, items)


def test_decontamination_edge_cases(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "x"), (2, "two line one two")], "item_id long, text string")
    found = decontamination.contained(odd_docs, items).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(5, 1), (11, 2)]
    clean = decontamination.decontaminate(odd_docs, items)
    assert clean.columns == odd_docs.columns and clean.count() == odd_docs.count() - 2
    assert decontamination.contained(no_docs, items).count() == 0
    assert decontamination.contained(odd_docs, items.limit(0)).count() == 0
    assert decontamination.decontaminate(odd_docs, items.limit(0)).count() == odd_docs.count()


