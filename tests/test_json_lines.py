"""JSON Lines feeds: what can't be parsed is kept, line by line, with its text."""

import datetime as dt
import json

from tillroll.operators import rules as R
from tillroll.plans import ingest
from tillroll.schemas import SPECS
from tillroll.sources import audit
from tillroll.sources.files import CORRUPT, load_json
from tillroll.sources.tables import TableStore
from tillroll.streaming import ingest_stream

SPEC = SPECS["payments"]
GOOD = '{"payment_id": "1", "order_id": "7", "amount": "2.50", "payment_status": "success"}'
BROKEN = ['{"payment_id": "2", "order', "not json", '{"payment_id": }', "[1, 2", '"just text"', " {broken} ", "123", "nul", '[{"payment_id": "8"}, 5]']


def _write(tmp_path, lines, name="payments.jsonl"):
    path = tmp_path / name
    path.mkdir(parents=True, exist_ok=True)
    (path / "part.jsonl").write_text("\n".join(lines) + "\n")
    return str(path)


def _rejects(tagged):
    return audit.rejected_records(tagged.where(~R.is_valid()), "s", "payments", SPEC.column_names, dt.datetime(2024, 1, 1)).collect()


def test_each_broken_line_is_a_reject_with_its_text(spark, tmp_path):
    path = _write(tmp_path, [GOOD, *BROKEN, "", "   ", GOOD.replace('"1"', '"3"')])
    tagged = ingest.prepare(load_json(spark, path, lines=True, schema=SPEC.feed_struct()), "payments")
    assert sorted(r.payment_id for r in tagged.where(R.is_valid()).collect()) == [1, 3]
    rejects = _rejects(tagged)
    assert sorted(json.loads(r.record_data)[CORRUPT] for r in rejects) == sorted(BROKEN)
    assert {r.reason for r in rejects} == {"malformed record"}


def test_equal_broken_lines_stay_apart_and_hide_no_record(spark, tmp_path):
    cut = '{"payment_id": "1", "order_id"'
    path = _write(tmp_path, [cut, cut, GOOD, cut])
    tagged = ingest.prepare(load_json(spark, path, lines=True, schema=SPEC.feed_struct()), "payments")
    assert [r.payment_id for r in tagged.where(R.is_valid()).collect()] == [1]
    assert len(_rejects(tagged)) == 3


def test_lines_without_a_schema_and_lists_in_lines(spark, tmp_path):
    path = _write(tmp_path, ['{"a": 1, "b": {"c": "x"}}', "oops", '{"a": 2}', '[{"a": 3}, {"a": 4}]'])
    df = load_json(spark, path, lines=True)
    assert sorted(r.a for r in df.where(f"{CORRUPT} is null").collect()) == [1, 2, 3, 4]
    assert [r[CORRUPT] for r in df.where(f"{CORRUPT} is not null").collect()] == ["oops"]


def test_an_empty_file_and_a_byte_order_mark(spark, tmp_path):
    assert load_json(spark, _write(tmp_path, [""], "none"), lines=True, schema=SPEC.feed_struct()).count() == 0
    path = _write(tmp_path, ["﻿" + GOOD], "marked")
    tagged = ingest.prepare(load_json(spark, path, lines=True, schema=SPEC.feed_struct()), "payments")
    assert [r.payment_id for r in tagged.where(R.is_valid()).collect()] == [1]


def test_a_stream_records_broken_lines_too(spark, tmp_path):
    path = _write(tmp_path, [GOOD, *BROKEN, BROKEN[1]], "feed")
    store = TableStore(spark, str(tmp_path / "wh"))
    ingest_stream(spark, store, "payments", path, str(tmp_path / "ckpt"), fmt="json", run_ts=dt.datetime(2024, 1, 1))
    assert [r.payment_id for r in store.read("raw", "payments").collect()] == [1]
    texts = [json.loads(r.record_data)[CORRUPT] for r in store.read_appended("audit", "rejected_records").collect()]
    assert sorted(texts) == sorted([*BROKEN, BROKEN[1]])


def test_pipeline_of_jsonl_feeds_with_broken_lines(spark, tmp_path):
    """Through the tagged first version and the audit table of a warehouse."""
    from tillroll.plans.warehouse import Warehouse, ingest_table

    wh = Warehouse(spark, str(tmp_path / "wh"), str(tmp_path))
    feed = load_json(spark, _write(tmp_path, [GOOD, "bad one", "bad two"]), lines=True, schema=SPEC.feed_struct())
    assert ingest_table(wh, "payments", feed, "jsonl") == (1, 2)
    assert wh.raw("payments").count() == 1 and CORRUPT not in wh.raw("payments").columns
    assert sorted(json.loads(r.record_data)[CORRUPT] for r in wh.rejected().collect()) == ["bad one", "bad two"]
