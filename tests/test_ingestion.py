"""Feed readers: happy paths and every error class (CSV and JSON)."""

import json

import pytest

from tillroll.sources.files import FeedLoadError, FeedNotFoundError, load_csv, load_json
from tillroll.sources.fixtures import SEQ


def test_csv_two_rows(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text("customer_id,first_name\n1,A\n2,NA\n")
    df = load_csv(spark, str(p), required_columns=["customer_id"])
    rows = sorted(df.select("customer_id", "first_name").collect())
    assert [tuple(r) for r in rows] == [("1", "A"), ("2", None)]  # NA token -> null, like pandas
    assert SEQ in df.columns


def test_csv_missing_file(spark, tmp_path):
    with pytest.raises(FeedNotFoundError):
        load_csv(spark, str(tmp_path / "nope.csv"))


def test_csv_missing_column(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text("customer_id\n1\n")
    with pytest.raises(FeedLoadError, match="missing required columns"):
        load_csv(spark, str(p), required_columns=["customer_id", "email"])


def test_csv_empty_file(spark, tmp_path):
    p = tmp_path / "e.csv"
    p.write_text("")
    with pytest.raises(FeedLoadError, match="empty"):
        load_csv(spark, str(p))


def test_csv_malformed_row_kept_for_rejection(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text("a,b\n1,2\n3,4,5,6\n")
    df = load_csv(spark, str(p))
    rows = df.select("a", "b", "_corrupt_record").collect()
    assert sum(r._corrupt_record is not None for r in rows) == 1


def test_json_list(spark, tmp_path):
    p = tmp_path / "p.json"
    p.write_text(json.dumps([{"payment_id": 1, "amount": 2.5}, {"payment_id": 2, "amount": 3}]))
    df = load_json(spark, str(p), required_columns=["payment_id"])
    assert df.count() == 2


def test_json_data_envelope_keeps_order(spark, tmp_path):
    p = tmp_path / "p.json"
    p.write_text(json.dumps({"data": [{"payment_id": 7}, {"payment_id": 3}, {"payment_id": 5}]}))
    df = load_json(spark, str(p))
    rows = df.orderBy(f"{SEQ}.pos").select("payment_id").collect()
    assert [r.payment_id for r in rows] == [7, 3, 5]


def test_json_missing_file(spark, tmp_path):
    with pytest.raises(FeedNotFoundError):
        load_json(spark, str(tmp_path / "nope.json"))


def test_json_wrong_shape(spark, tmp_path):
    p = tmp_path / "w.json"
    p.write_text(json.dumps({"items": [1, 2]}))
    with pytest.raises(FeedLoadError, match="list of records"):
        load_json(spark, str(p))


def test_json_empty_list(spark, tmp_path):
    p = tmp_path / "e.json"
    p.write_text("[]")
    with pytest.raises(FeedLoadError, match="no records"):
        load_json(spark, str(p))


def test_json_malformed(spark, tmp_path):
    p = tmp_path / "bad.json"
    p.write_text("[{\"a\": 1,,}")
    with pytest.raises(FeedLoadError):
        load_json(spark, str(p))


def test_json_lines(spark, tmp_path):
    p = tmp_path / "p.jsonl"
    p.write_text('{"payment_id": 1, "amount": 2.5}\n{"payment_id": 2, "amount": 3}\n')
    from tillroll.schemas import PAYMENTS

    df = load_json(spark, str(p), lines=True, schema=PAYMENTS.feed_struct())
    rows = sorted((r.payment_id, r.amount) for r in df.collect())
    assert rows == [("1", "2.5"), ("2", "3")]  # values read as text, typed later by try_cast
