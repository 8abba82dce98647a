"""Several writers of one table, and upserts that touch a part of it."""

import datetime as dt
import random
import threading

import pytest

from tillroll.operators.joins import CONF_KEY
from tillroll.sources import fs
from tillroll.sources.tables import ConcurrentWriteError, TableStore
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("w", T.StringType())])


def _upsert(store, spark, rows, day=1, columns="id long, v string, w string"):
    return store.upsert(spark.createDataFrame(rows, columns), "t", ["id"], SCHEMA, dt.datetime(2024, 1, day))


def _rows(store):
    return {r.id: (r.v, r.w) for r in store.read("raw", "t").collect()}


def test_two_stores_in_turn_lose_no_row(spark, tmp_path):
    a, b = (TableStore(spark, str(tmp_path / "wh")) for _ in range(2))
    _upsert(a, spark, [(1, "a", None)])
    _upsert(b, spark, [(2, "b", None)])
    _upsert(a, spark, [(3, "a", None)])
    assert sorted(_rows(a)) == sorted(_rows(b)) == [1, 2, 3]
    extra = spark.createDataFrame([(9, "x", None)], SCHEMA)
    b.load(extra, "t", "append")
    a.load(extra, "t", "append")
    assert b.read("raw", "t").count() == 5
    a.truncate("t")
    assert b.read("raw", "t").count() == 0


def test_writers_at_the_same_time_lose_no_row(spark, tmp_path):
    root = str(tmp_path / "wh")
    _upsert(TableStore(spark, root), spark, [(0, "start", None)])
    failed = []

    def write(i):
        try:
            _upsert(TableStore(spark, root), spark, [(i, f"w{i}", None), (0, f"w{i}", None)], day=i)
        except Exception as exc:  # noqa: BLE001 - shown below
            failed.append(exc)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(1, 6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    store = TableStore(spark, root)
    assert not failed and sorted(_rows(store)) == list(range(6))
    versions = store.versions("raw", "t")
    assert len(versions) == 6  # each batch made one version


def test_a_version_from_an_old_base_is_refused(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"))
    df = spark.createDataFrame([(1, "a", None)], SCHEMA)
    store.write(df, "raw", "t")
    base = store.current_version("raw", "t")
    store.write(df, "raw", "t", base=base)
    with pytest.raises(ConcurrentWriteError):
        store.write(df, "raw", "t", base=base)
    assert store.versions("raw", "t") == [1, 2]


def test_a_writer_that_died_after_its_claim_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "wh"))
    _upsert(store, spark, [(1, "a", None)])
    _upsert(store, spark, [(2, "b", None)])
    fs.delete(spark, f"{store.path('raw', 't')}/v000002/_SUCCESS")  # as if it had died just before
    monkeypatch.setattr("tillroll.sources.tables.time.sleep", lambda s: None)
    _upsert(TableStore(spark, store.root), spark, [(3, "c", None)])
    assert sorted(_rows(TableStore(spark, store.root))) == [1, 2, 3]


def _sizes(store, spark):
    return {v: fs.size(spark, f"{store.path('raw', 't')}/v{v:06d}") for v in store.versions("raw", "t")}


@pytest.mark.parametrize("broadcast", ["", "1"])
def test_a_small_batch_rewrites_the_buckets_of_its_keys_alone(spark, tmp_path, broadcast):
    rng = random.Random(3)
    store = TableStore(spark, str(tmp_path / "wh"), bucket_bytes=4_000)
    text = lambda: "".join(rng.choices("abcdefgh", k=40))
    want = {i: (text(), text()) for i in range(3000)}
    if broadcast:
        spark.conf.set(CONF_KEY, broadcast)  # nothing fits: the full outer join
    try:
        _upsert(store, spark, [(i, *x) for i, x in want.items()])
        _upsert(store, spark, [(1, "one", None)], day=2)  # deals the table into buckets
        want[1] = ("one", None)
        folders, buckets = store._layout(store.current_path("raw", "t"))
        assert buckets > 10 and len(folders) <= buckets and _rows(store) == want
        _upsert(store, spark, [(2, "two", None), (5000, "new", "w")], day=3)
        want |= {2: ("two", None), 5000: ("new", "w")}
        assert _rows(store) == want
        sizes = _sizes(store, spark)
        assert sizes[3] < sizes[2] / 4  # two buckets of many
        plan = store.read("raw", "t")
        assert plan.columns == ["id", "v", "w", "created_at", "updated_at"]
        stamps = {r.id: (r.created_at.day, r.updated_at.day) for r in plan.where("id in (1, 2, 3, 5000)").collect()}
        assert stamps == {1: (1, 2), 2: (1, 3), 3: (1, 1), 5000: (3, 3)}
        # a batch without a column keeps it
        _upsert(store, spark, [(3, "three")], day=4, columns="id long, v string")
        want[3] = ("three", want[3][1])
        assert _rows(store) == want
    finally:
        spark.conf.unset(CONF_KEY)


def test_only_touched_buckets_are_read(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"), bucket_bytes=2_000)
    _upsert(store, spark, [(i, f"v{i:040d}", "") for i in range(2000)])
    _upsert(store, spark, [(7, "x", "y")], day=2)
    read = []
    plain = store._read_parts
    store._read_parts = lambda parts: read.append(list(parts)) or plain(parts)
    _upsert(store, spark, [(7, "z", "y")], day=3)
    assert len(read[0]) == 1 and "_bucket=" in read[0][0]


def test_append_to_a_table_in_buckets_then_upsert_and_expire(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"), bucket_bytes=2_000)
    _upsert(store, spark, [(i, f"v{i:040d}", "") for i in range(1000)])
    _upsert(store, spark, [(1, "one", "")], day=2)
    store.load(store.read("raw", "t").where("id = 0").selectExpr("5000L as id", "v", "w", "created_at", "updated_at"), "t", "append")
    assert len(_rows(store)) == 1001
    _upsert(store, spark, [(5000, "late", "")], day=4)
    rows = _rows(store)
    assert len(rows) == 1001 and rows[5000] == ("late", "") and rows[1] == ("one", "")
    _upsert(store, spark, [(2, "two", "")], day=5)
    before = _rows(store)
    assert store.expire("raw", "t", 1) == [1, 2, 3]  # version 4 still holds buckets of version 5
    assert _rows(TableStore(spark, store.root)) == before and store.versions("raw", "t") == [5]
    _upsert(store, spark, [(i, f"n{i:040d}", "") for i in range(1000)], day=6)  # touches every bucket
    assert 4 in store.expire("raw", "t", 1) and len(_rows(store)) == 1001


def test_buckets_grow_with_the_table(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"), bucket_bytes=3_000)
    _upsert(store, spark, [(i, f"v{i:040d}", "") for i in range(400)])
    _upsert(store, spark, [(1, "x", "")], day=2)
    _, few = store._layout(store.current_path("raw", "t"))
    for day, n in ((3, 6000), (4, 6001)):
        _upsert(store, spark, [(i, f"v{i:040d}-{day}", "") for i in range(n)], day=day)
    _, many = store._layout(store.current_path("raw", "t"))
    assert many > 2 * few and len(_rows(store)) == 6001


def test_scratch_folders_are_an_applications_own(spark):
    from tillroll.session import clear_scratch, scratch_dir, work_root

    mine, other = scratch_dir(spark, "x"), f"{work_root(spark)}/scratch/another-application/x"
    for p in (mine, other):
        spark.range(3).write.parquet(p)
    clear_scratch(spark)
    assert not fs.exists(spark, mine) and fs.exists(spark, other)
    fs.delete(spark, other)
