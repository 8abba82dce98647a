"""Cleaning, coercion and revenue functions (literal cases of the reference's unit tests)."""

import datetime as dt
from decimal import Decimal

from tillroll.functions import coerce_dates, coerce_numeric, normalize_emails, standardize_text_case, trim_whitespace
from tillroll.functions.coerce import add_line_total
from tillroll.operators import drop_exact_duplicates
from tillroll.plans import aggregations


def test_trim_whitespace(spark):
    df = spark.createDataFrame([("  Kanpur ",), ("Mumbai  ",)], "city string")
    assert [r.city for r in trim_whitespace(df, ["city", "absent"]).collect()] == ["Kanpur", "Mumbai"]


def test_trim_strips_unicode_spaces(spark):
    df = spark.createDataFrame([(" \tX y ",)], "c string")
    assert trim_whitespace(df, ["c"]).first().c == "X y"


def test_standardize_title_case(spark):
    df = spark.createDataFrame([("SHIPPED",), ("delivered",), ("o'neil mc-donald",)], "s string")
    out = [r.s for r in standardize_text_case(df, ["s"], "title").collect()]
    assert out == ["Shipped", "Delivered", "O'Neil Mc-Donald"]


def test_drop_exact_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id int, v string")
    assert drop_exact_duplicates(df).count() == 2


def test_keep_first_by_key_uses_order(spark):
    df = spark.createDataFrame([(1, "late", 2), (1, "early", 1), (None, "n1", 3), (None, "n2", 4)],
                               "id int, v string, pos int")
    out = {r.id: r.v for r in drop_exact_duplicates(df, ["id"], order=["pos"]).collect()}
    assert out == {1: "early", None: "n1"}


def test_normalize_emails(spark):
    df = spark.createDataFrame([(" User@Example.com ",)], "email string")
    assert normalize_emails(df).first().email == "user@example.com"


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("10.5",), ("not-a-number",), ("20",)], "price string")
    out = [r.price for r in coerce_numeric(df, ["price"]).collect()]
    assert out == [Decimal("10.50"), None, Decimal("20.00")]


def test_coerce_dates(spark):
    df = spark.createDataFrame([("2024-01-01",), ("invalid-date",)], "d string")
    assert [r.d for r in coerce_dates(df, ["d"]).collect()] == [dt.date(2024, 1, 1), None]


def test_add_line_total(spark):
    df = spark.createDataFrame([(2, Decimal("10"), Decimal("1")), (3, Decimal("5"), Decimal("0"))],
                               "quantity int, unit_price decimal(12,2), discount decimal(12,2)")
    assert [r.line_total for r in add_line_total(df).collect()] == [Decimal("19.00"), Decimal("15.00")]


def test_add_line_total_without_discount(spark):
    df = spark.createDataFrame([(2, Decimal("10"))], "quantity int, unit_price decimal(12,2)")
    assert add_line_total(df).first().line_total == Decimal("20.00")


ITEMS = "order_id int, product_id int, quantity int, unit_price decimal(12,2), discount decimal(12,2)"


def test_total_revenue(spark):
    items = spark.createDataFrame(
        [(1, 1, 1, Decimal("10"), Decimal("0")), (1, 2, 2, Decimal("5"), Decimal("0")),
         (2, 1, 1, Decimal("20"), Decimal("5"))], ITEMS)
    assert aggregations.total_revenue(items).first().total_revenue == Decimal("35.00")


def test_average_order_value(spark):
    items = spark.createDataFrame(
        [(1, 1, 1, Decimal("10"), Decimal("0")), (1, 2, 1, Decimal("10"), Decimal("0")),
         (2, 1, 1, Decimal("10"), Decimal("0"))], ITEMS)
    assert aggregations.average_order_value(items).first().average_order_value == 15.0
    empty = spark.createDataFrame([], ITEMS)
    assert aggregations.average_order_value(empty).first().average_order_value == 0.0


def test_revenue_by_date(spark):
    items = spark.createDataFrame(
        [(1, 1, 1, Decimal("10"), Decimal("0")), (2, 1, 1, Decimal("20"), Decimal("0"))], ITEMS)
    orders = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 1))], "order_id int, order_date date")
    rows = aggregations.revenue_by_date(items, orders).collect()
    assert len(rows) == 1 and rows[0].revenue == Decimal("30.00")


def test_top_n_products(spark):
    items = spark.createDataFrame(
        [(1, 1, 1, Decimal("100"), Decimal("0")), (1, 2, 1, Decimal("5"), Decimal("0"))], ITEMS)
    products = spark.createDataFrame([(1, "Laptop"), (2, "Pen")], "product_id int, product_name string")
    rows = aggregations.top_n_products(items, products, n=2).collect()
    assert rows[0].product_name == "Laptop" and rows[1].product_name == "Pen"


def test_integer_coercion_accepts_integral_text(spark):
    from tillroll.functions import coerce_to

    df = spark.createDataFrame([("2",), ("2.0",), ("2.5",), ("-2.5",), (" 3 ",), ("1e2",), ("abc",), (None,)], "q string")
    out = [r.q for r in df.select(coerce_to("q", "int").alias("q")).collect()]
    assert out == [2, 2, 3, -3, 3, 100, None, None]
    typed = spark.createDataFrame([(2.5,), (7.0,)], "q double")
    assert [r.q for r in typed.select(coerce_to("q", "bigint", typed.schema["q"].dataType).alias("q")).collect()] == [3, 7]


def test_date_forms(spark):
    df = spark.createDataFrame([("2024-01-05",), ("01/05/2024",), ("2024/1/5",), ("31-31-2026",), ("not-a-date",)], "d string")
    out = [r.d for r in coerce_dates(df, ["d"]).collect()]
    assert out == [dt.date(2024, 1, 5), dt.date(2024, 1, 5), dt.date(2024, 1, 5), None, None]
