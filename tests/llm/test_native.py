"""Mixing, sharding, pseudonyms."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.util import rows, same_as_sql
from tillroll.llm import mixing, oracle, pseudonyms, sharding
from tillroll.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_mixing_query_equals_its_sql(spark, tables):
    same_as_sql(QUERIES["op8_mixing"](spark, SF), tables, ORACLE_SQL["op8_mixing"])


def _sources(spark, shares):
    rng = random.Random(8)
    out, i = [], 0
    for source, n in shares.items():
        for _ in range(n):
            out.append((i, " ".join(["w#" if rng.random() < 0.1 else "w"] * rng.randint(0, 60)) + f" d{i}", source))
            i += 1
    return spark.createDataFrame(out, "doc_id long, text string, source string")


def _water(sizes, most=3):
    """Excess reshared by weight until no target lies above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, free, rest = {}, set(order), sum(sizes.values())
    while free:
        level = rest / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > most * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        for s in over:
            target[s] = most * sizes[s]
            rest -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("shares", [{"a": 900, "b": 40, "c": 5, None: 300}, {"a": 3, "b": 3, "c": 3, "d": 700}, {"only": 50}])
def test_mix_meets_targets_and_equals_the_sql(spark, shares):
    df = _sources(spark, shares)
    got = mixing.mixture(df)
    pdf = got.toPandas()
    sizes = defaultdict(int)
    for s, n in zip(pdf.source, pdf["size"]):
        sizes[s] += int(n)
    want = _water(sizes)
    for s, part in pdf.groupby("source", dropna=False):
        s = None if s != s else s
        assert part.target.iloc[0] == pytest.approx(want[s])
        assert abs(part.taken.sum() - want[s]) <= part["size"].max()
        assert (part.copies <= 3).all() and part.copies.max() - part.copies.min() <= 1
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    same_as_sql(got.drop("source"), con, oracle.mixing())
    assert rows(got) == rows(mixing.mixture(df.repartition(7)))
    mixed = Counter(r["doc_id"] for r in mixing.mix(df).collect())
    assert mixed == Counter({r["doc_id"]: r["copies"] for r in got.collect() if r["copies"]})


def test_documents_of_higher_weight_are_taken_more_often(spark):
    text = F.when(F.col("id") % 2 == 0, F.concat(F.repeat(F.lit("w "), 50), F.col("id"))).otherwise(F.concat(F.repeat(F.lit("# "), 50), F.col("id")))
    df = spark.range(4000).select(F.col("id").alias("doc_id"), text.alias("text"), F.when(F.col("id") < 3000, "a").otherwise("b").alias("source"))
    pdf = mixing.mixture(df).where("source = 'a'").toPandas()
    clean, dirty = pdf[pdf.doc_id % 2 == 0].copies.mean(), pdf[pdf.doc_id % 2 == 1].copies.mean()
    assert clean > 3 * dirty > 0


def test_key_buckets_stay_small_whatever_the_weight(spark):
    """At weights of 0.1 and 1 no bucket holds more than a few of 20,000 keys."""
    for weight in (0.1, 0.2, 1.0):
        keys = spark.range(20_000).select(mixing.sampling_key(F.col("id"), F.lit("t"), F.lit(weight)).alias("x"))
        held = keys.select("x", mixing._bucket(F.col("x")).alias("b"))
        assert held.groupBy("b").count().agg(F.max("count")).first()[0] <= 5
        pdf = held.orderBy("x").toPandas()
        assert pdf.b.is_monotonic_increasing


def test_mixing_edge_cases(spark, odd_docs, no_docs):
    got = mixing.mixture(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(r["taken"] == 0 for r in got if r["doc_id"] in (3, 4, 6))
    mixed = mixing.mix(odd_docs)
    assert mixed.columns == odd_docs.columns and set(rows(mixed)) <= set(rows(odd_docs))
    assert mixing.mixture(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0


def _check_shards(got, n):
    slots = defaultdict(list)
    texts = defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        texts[r["text"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(n))
    assert all(len(s) == 1 for s in texts.values())


def test_shards_of_the_documents(spark, docs):
    got = sharding.shard(docs).collect()
    assert len(got) == docs.count()
    _check_shards(got, 8)
    for r in got:
        assert r["size"] == len(r["text"].encode()) + 1 and r["text_crc32"] == zlib.crc32(r["text"].encode())
    bytes_ = Counter()
    for r in got:
        bytes_[r["shard"]] += r["size"]
    most = max(r["size"] for r in got)
    assert max(bytes_.values()) - min(bytes_.values()) <= 2 * most


def _best(sizes, n):
    """Smallest capacity for n contiguous parts, by dynamic programming."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    best = total[1:].astype(float)
    for _ in range(n - 1):
        best = np.array([min(max(best[j - 1] if j else 0, total[i + 1] - total[j]) for j in range(i + 1)) for i in range(len(sizes))])
    return best[-1]


@pytest.mark.parametrize("seed", range(12))
def test_partition_is_minimax(seed):
    rng = np.random.RandomState(seed)
    sizes = rng.randint(1, 50, rng.randint(1, 60))
    if seed % 3 == 0:
        sizes[rng.randint(len(sizes))] = 2000
    n = int(rng.randint(1, 9))
    # keys that share their first bits, so some nodes have parts of parts
    keys = np.sort(rng.choice(1 << 14, len(sizes), replace=False).astype(np.int64)) << int(rng.choice([20, 34, 47]))
    fetched = []

    def rows(bits, keep):
        prefix = keys >> (63 - bits)
        return [(int(p), int(sizes[prefix == p].sum()), int((prefix == p).sum()), int(keys[prefix == p].min())) for p in np.unique(prefix[keep])]

    def parts_of(nodes):
        fetched.extend((n.bits, n.prefix) for n in nodes)
        return [(n, rows(n.bits + 8, keys >> (63 - n.bits) == n.prefix)) for n in nodes]

    order = sharding.Order(rows(16, sizes > 0), parts_of)
    cuts = sharding.boundaries(order, n, int(sizes.max()))
    ends = set(np.concatenate([[0], np.cumsum(sizes)]).tolist())
    assert cuts == sorted(cuts) and set(cuts) <= ends
    parts = np.diff([0, *cuts, sizes.sum()])
    assert parts.max() == _best(sizes, n)
    assert len(fetched) == len(set(fetched))


def test_the_query_cuts_at_the_minimax_capacity(spark, tmp_path):
    """The registered query against a plain one: groups by text in key order, the best
    capacity by dynamic programming, gapless slots."""
    rng = np.random.RandomState(7)
    texts = ["".join(rng.choice(list("abé "), rng.randint(0, 60))) for _ in range(70)] + [None, "", "big " * 400]
    rows = [(i, texts[rng.randint(len(texts))]) for i in range(300)] + [(5, "twice")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op10_sharding"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    total = Counter()
    for r in got:
        total[r["shard"]] += r["size"]
        assert 0 <= r["shard"] < 8
    for s in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    keyed = df.select(F.xxhash64("text").alias("k"), "text").collect()
    groups = Counter()
    for r in keyed:
        groups[r["k"]] += size(r["text"])
    sizes = np.array([groups[k] for k in sorted(groups)])
    assert max(total.values()) == _best(sizes, 8)


def test_many_groups_in_one_range_are_found_part_by_part(spark):
    """Keys that differ in their last bits alone."""
    keyed = spark.range(3000).select((F.col("id") - 1500).alias("key"), (F.col("id") % 17 + 1).alias("size"))
    cuts = sharding.cut_keys(keyed, 8)
    sizes = np.array([i % 17 + 1 for i in range(3000)])
    parts = [sizes[a:b].sum() for a, b in zip([0, *(c + 1500 for c in cuts)], [*(c + 1500 for c in cuts), 3000])]
    assert max(parts) == _best(sizes, 8) if len(sizes) < 500 else max(parts) - min(parts) <= 40


def test_sharding_edge_cases(spark, odd_docs, no_docs):
    got = sharding.shard(odd_docs)
    assert got.columns == [*odd_docs.columns, "_size", "text_crc32", "_shard", "slot"]
    found = [r.asDict() | {"shard": r["_shard"]} for r in got.collect()]
    assert len(found) == odd_docs.count()
    _check_shards(found, 8)
    assert sharding.shard(no_docs).count() == 0
    same = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one text").alias("text"))
    found = sharding.shard(same).collect()
    _check_shards(found, 8)
    assert len({r["shard"] for r in found}) == 1 and sorted(r["slot"] for r in found) == list(range(3000))


def _perm(spark, values, key="k"):
    df = spark.createDataFrame([(v,) for v in values], "text string")
    return [r["text"] for r in pseudonyms.pseudonymise(df, key).collect()]


def test_feistel_is_a_permutation(spark):
    for a, b in [(189, 773), (10, 7), (1, 13), (256, 256)]:
        out = spark.range(a * b).select(pseudonyms.feistel(F.col("id"), F.lit(a).cast("long"), F.lit(b).cast("long"), "k", F.lit("t")).alias("y"))
        got = [r["y"] for r in out.collect()]
        assert sorted(got) == list(range(a * b))
        if a * b > 1000:
            assert sum(i == y for i, y in enumerate(got)) < 20


def _luhn(digits):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def test_every_kind_keeps_its_format(spark):
    rng = random.Random(5)
    cards = []
    for n in (13, 15, 16, 19):
        for _ in range(30):
            body = "4" + "".join(rng.choices("0123456789", k=n - 2))
            cards.append(next(body + c for c in "0123456789" if _luhn(body + c)))
    out = _perm(spark, cards)
    assert len(set(out)) == len(set(cards)) and all(_luhn(o) and len(o) == len(c) and o[0] == "4" and o != c for o, c in zip(out, cards))
    import datetime

    dates = [datetime.date(1800, 1, 1) + datetime.timedelta(rng.randrange(146097)) for _ in range(200)]
    for form in ("%Y-%m-%d", "%d.%m.%Y", "%d/%m/%Y"):
        out = _perm(spark, [d.strftime(form) for d in dates])
        back = [datetime.datetime.strptime(o, form).date() for o in out]
        assert len(set(back)) == len(set(dates)) and all(1800 <= d.year < 2200 for d in back)
    phones = [f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(0, 9999):04}" for _ in range(200)]
    out = _perm(spark, phones)
    assert len(set(out)) == len(set(phones)) and all(o[1] >= "2" and o[6] >= "2" and len(o) == 14 for o in out)
    assert _perm(spark, ["+1 " + p for p in phones]) == ["+1 " + o for o in out]
    ssns = ["001-01-0001", "899-99-9999", "665-50-0005", "667-50-0005"]
    out = _perm(spark, ssns)
    assert len(set(out)) == 4 and all(o[:3] not in ("000", "666") and o[0] != "9" and o[4:6] != "00" and o[7:] != "0000" for o in out)
    ips = [".".join(str(rng.randrange(256)) for _ in range(4)) for _ in range(200)]
    out = _perm(spark, ips)
    assert len(set(out)) == len(set(ips)) and all(all(0 <= int(x) < 256 for x in o.split(".")) for o in out)


def test_every_slash_date_has_a_pseudonym_of_its_own(spark):
    """Both readings of a '/' date: those that are dates month first only are permuted
    among themselves. 28,224 dates of 48 years, and the ends of the range."""
    import datetime

    days = [datetime.date(1980, 1, 1) + datetime.timedelta(i) for i in range(17_532)] + [
        datetime.date(1800, 1, 13), datetime.date(1800, 12, 31), datetime.date(2199, 12, 31), datetime.date(2000, 2, 29), datetime.date(1900, 2, 28)]
    shown = sorted({d.strftime("%d/%m/%Y") for d in days} | {d.strftime("%m/%d/%Y") for d in days})
    out = _perm(spark, shown)
    assert len(shown) > 28_000 and len(set(out)) == len(shown)
    for a, b in zip(shown, out):
        month_first = int(a[3:5]) > 12
        assert (int(b[3:5]) > 12) == month_first
        back = datetime.datetime.strptime(b, "%m/%d/%Y" if month_first else "%d/%m/%Y")
        assert 1800 <= back.year < 2200


def test_month_first_dates_are_permuted_onto_themselves(spark):
    """The whole set of such days maps onto itself."""
    import datetime

    first = datetime.date(1800, 1, 1)
    shown = [d.strftime("%m/%d/%Y") for d in (first + datetime.timedelta(i) for i in range(146_097)) if d.day > 12]
    assert len(shown) == 88_497 == 9 * 9833
    assert sorted(_perm(spark, shown)) == sorted(shown)


def test_phone_numbers_outside_the_number_plan(spark):
    rng = random.Random(9)
    pairs = [(17, 555), (132, 555), (0, 0), (199, 999), (200, 0), (999, 199), (200, 199), (199, 200)]
    pairs += [(rng.randrange(200), rng.randrange(1000)) for _ in range(100)] + [(rng.randrange(200, 1000), rng.randrange(200)) for _ in range(100)]
    phones = sorted({f"({a:03}) {e:03}-{rng.randrange(10000):04}" for a, e in pairs})
    out = _perm(spark, phones)
    assert len(set(out)) == len(phones) and all(o != p and len(o) == 14 for o, p in zip(out, phones))
    assert all(o[1] < "2" or o[6] < "2" for o in out)
    assert _perm(spark, ["+1 " + p for p in phones]) == ["+1 " + o for o in out]
    df = spark.createDataFrame([("call +1 (017) 555-7713 or 132-555-1352",)], "text string")
    r = pseudonyms.pseudonymise(df, "k", counts=True).collect()[0]
    assert r["n_phone"] == 2 and "555-7713" not in r["text"] and "132-555-1352" not in r["text"]


def test_every_phone_number_found_is_replaced(spark, docs):
    out = QUERIES["op7_pseudonyms"](spark, SF).withColumnRenamed("text", "new").join(docs.select("doc_id", "text"), "doc_id")
    form = r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}"
    texts = out.select("text", "new", "n_phone").collect()
    found = [(p, r["new"]) for r in texts for p in re.findall(form, r["text"])]
    assert found and not [p for p, new in found if p in new]
    assert sum(r["n_phone"] for r in texts) >= len(found)


def test_pseudonyms_link_across_documents_and_keep_the_rest(spark):
    texts = ["Call +1 (499) 555-6503!!! now", "499-555-6503", "pay 4111 1111 1111 1111, or 4111111111111111.", "4111111111111112 300.1.1.1 2021-02-30 000-12-3456",
             "at 152.143.123.131.", "A@x.example.com wrote; a@x.example.com too", "v1.2.3.4.5 12345678901234567890 abc4111111111111111", "é 漢 2020-02-29 $$"]
    out = _perm(spark, texts)
    assert out[0].startswith("Call +1 (") and out[0].endswith("!!! now") and "499" not in out[0][:13]
    assert out[0][8:22].replace("(", "").replace(") ", "-") == out[1]
    a, b = out[2][4:23], out[2][28:44]
    assert a.replace(" ", "") == b and out[2].endswith(".")
    assert out[3] == texts[3] and out[6] == texts[6]
    assert out[4].startswith("at ") and out[4].endswith(".") and out[4] != texts[4]
    local = [w.split("@")[0] for w in out[5].split() if "@" in w]
    assert local[0] == local[1] != "A"
    assert out[7].startswith("é 漢 ") and out[7].endswith(" $$") and out[7] != texts[7]
    assert _perm(spark, texts, "other key")[0] != out[0]


def test_pseudonyms_edge_cases(spark, odd_docs, no_docs):
    assert rows(pseudonyms.pseudonymise(odd_docs, "k")) == rows(odd_docs)
    assert pseudonyms.pseudonymise(no_docs, "k", counts=True).count() == 0
    clash = odd_docs.select("doc_id", "text", odd_docs.n_words.alias("n_phone"))
    assert pseudonyms.pseudonymise(clash, "k", counts=True).columns == ["doc_id", "text", "n_phone", "n_email", "n_date", "n_ip", "_n_phone", "n_ssn", "n_card"]
    counted = pseudonyms.pseudonymise(odd_docs.select("doc_id", "text"), "k", counts=True).collect()
    assert all(r[f"n_{k}"] == 0 for r in counted for k in pseudonyms.PATTERNS)


def test_pseudonym_query_leaves_no_found_value(spark, docs):
    out = QUERIES["op7_pseudonyms"](spark, SF).withColumnRenamed("text", "new").join(docs.select("doc_id", "text"), "doc_id")
    pattern = F.lit(pseudonyms.ANY)
    pairs = out.select(F.explode(F.arrays_zip(F.regexp_extract_all("text", pattern, F.lit(0)).alias("a"), F.regexp_extract_all("new", pattern, F.lit(0)).alias("b"))).alias("p"))
    found = pairs.select("p.a", "p.b", pseudonyms.kind_of(F.col("p.a")).alias("k")).where("k is not null").collect()
    assert found and all(r["a"] != r["b"] for r in found)
    links = defaultdict(set)
    for r in found:
        links[r["a"]].add(r["b"])
    assert all(len(v) == 1 for v in links.values())


def test_native_operators_run_no_python(spark):
    for name in ("op7_pseudonyms", "op8_mixing", "op10_sharding"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
    assert "op8_mixing" in ORACLE_SQL
