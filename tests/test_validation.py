"""Validation rules and the tagged projection (literal cases of the reference's unit tests)."""

from decimal import Decimal

from tillroll.operators import rules as R
from tillroll.plans import ingest
from tillroll.schemas import CUSTOMERS, VALID_PAYMENT_STATUSES
from tillroll.sources.fixtures import SEQ


def _counts(res):
    valid, invalid, _ = res
    return valid.count(), invalid.count()


def test_null_required_value(spark):
    df = spark.createDataFrame(
        [(1, "A", "B", "a@x", "2024-01-01", (1,)), (2, None, "B", "b@x", "2024-01-01", (2,)),
         (3, "C", "D", "c@x", "2024-01-01", (3,))],
        f"customer_id long, first_name string, last_name string, email string, signup_date string, {SEQ} struct<p:int>")
    tagged = ingest.prepare(df, "customers")
    valid, rejected = R.split(tagged)
    assert valid.count() == 2 and rejected.count() == 1
    assert rejected.first()[R.REASON] == "null in required column first_name"


def test_missing_required_columns(spark):
    df = spark.createDataFrame([(1, (1,))], f"customer_id long, {SEQ} struct<p:int>")
    assert R.missing_columns(df, CUSTOMERS.required_columns) == ["email", "first_name", "last_name", "signup_date"]
    valid, rejected = R.split(ingest.prepare(df, "customers"))
    assert valid.count() == 0 and rejected.count() == 1
    assert rejected.first()[R.REASON].startswith("Missing required columns")


def test_positive_quantity(spark):
    df = spark.createDataFrame([(1,), (-2,), (3,), (0,)], "quantity int")
    assert _counts(R.check_positive_quantity(df)) == (2, 2)


def test_non_negative(spark):
    df = spark.createDataFrame([(10,), (-5,), (0,)], "price int")
    assert _counts(R.check_non_negative(df, "price")) == (2, 1)


def test_accepted_values(spark):
    df = spark.createDataFrame([("success",), ("failed",), ("bogus",)], "s string")
    assert _counts(R.check_accepted_values(df, "s", VALID_PAYMENT_STATUSES)) == (2, 1)


def test_valid_date(spark):
    df = spark.createDataFrame([("2024-01-01",), ("not-a-date",), ("2024-03-15",)], "d string")
    assert _counts(R.check_valid_date(df, "d")) == (2, 1)


def test_duplicate_ids_first_kept(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (2, 2), (3, 3)], "id int, pos int")
    valid, invalid, reason = R.check_no_duplicate_ids(df, "id", ["pos"])
    assert valid.count() == 3 and invalid.count() == 1
    assert invalid.first().pos == 2 and reason == "duplicate id"


def test_null_quantity_is_invalid(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, None, Decimal("10"), Decimal("0"), (1,))],
        f"order_item_id long, order_id long, product_id long, quantity int, unit_price decimal(12,2), "
        f"discount decimal(12,2), {SEQ} struct<p:int>")
    valid, rejected = R.split(ingest.prepare(df, "order_items"))
    assert valid.count() == 0 and rejected.count() == 1


def test_discount_cap(spark):
    df = spark.createDataFrame([(2, Decimal("10"), Decimal("5")), (1, Decimal("5"), Decimal("6"))],
                               "quantity int, unit_price decimal(12,2), discount decimal(12,2)")
    assert _counts(R.check_discount_not_exceed_line_value(df)) == (1, 1)


def test_null_fails_every_rule(spark):
    df = spark.createDataFrame([(None,)], "quantity int")
    assert _counts(R.check_positive_quantity(df)) == (0, 1)


def test_first_failing_rule_is_the_reason(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, -1, Decimal("-1"), Decimal("0"), (1,)), (2, 1, 1, 1, Decimal("1"), None, (2,))],
        f"order_item_id long, order_id long, product_id long, quantity int, unit_price decimal(12,2), "
        f"discount decimal(12,2), {SEQ} struct<p:int>")
    rows = {r.order_item_id: r for r in ingest.prepare(df, "order_items").collect()}
    assert rows[1][R.REASON] == "quantity must be greater than 0"
    assert rows[1][R.REASONS] == ["quantity must be greater than 0", "unit_price must not be negative"]
    assert rows[2][R.REASON] == "discount must not be negative"


def test_missing_discount_column_defaults_to_zero(spark):
    df = spark.createDataFrame([(1, 1, 1, 2, Decimal("3"), (1,))],
                               f"order_item_id long, order_id long, product_id long, quantity int, "
                               f"unit_price decimal(12,2), {SEQ} struct<p:int>")
    row = ingest.prepare(df, "order_items").first()
    assert row.discount == Decimal("0.00") and row[R.REASONS] == []


def test_validate_schema_result(spark):
    df = spark.createDataFrame(
        [(1, "A", "B", "a@x", "2024-01-01"), (2, None, "B", "b@x", "2024-01-01"), (3, "C", "D", "c@x", "2024-01-01")],
        "customer_id long, first_name string, last_name string, email string, signup_date string")
    res = R.validate_schema(df, CUSTOMERS)
    assert res.valid_rows.count() == 2 and res.invalid_rows.count() == 1 and not res.is_valid
    assert res.errors == ["1 row(s) have null values in required columns "
                          "['customer_id', 'first_name', 'last_name', 'email', 'signup_date']"]
    only_id = R.validate_schema(df.select("customer_id"), CUSTOMERS)
    assert only_id.valid_rows.count() == 0 and only_id.invalid_rows.count() == 3
    assert only_id.errors[0].startswith("Missing required columns")


def test_missing_key_column_rejects_every_row(spark):
    df = spark.createDataFrame([("A", (1,)), ("B", (2,)), ("C", (3,))], f"first_name string, {SEQ} struct<p:int>")
    valid, rejected = R.split(ingest.prepare(df, "customers"))
    assert valid.count() == 0 and rejected.count() == 3
