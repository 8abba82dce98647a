"""The expected figures of FIXTURES.md §4 at sf0.01, asserted directly."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tillroll.plans.warehouse import open_warehouse

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def wh(spark):
    return open_warehouse(spark, SF)


def test_accepted_rows(wh):
    counts = {t: wh.raw(t).count() for t in ("customers", "stores", "products", "orders", "order_items", "payments")}
    assert counts == {"customers": 1440, "stores": 100, "products": 1960, "orders": 14700,
                      "order_items": 43457, "payments": 7829}
    assert wh.raw("products").filter(F.col("category").isNotNull()).count() == 1742


def test_fact_figures(wh):
    r = wh.fact.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("order_id").alias("o"),
                    F.count("store_key").alias("s"), F.sum("quantity").alias("q"),
                    F.sum("total_amount").alias("t")).first()
    assert (r.n, r.o, r.s, r.q, r.t) == (39568, 12990, 36529, 1004691, Decimal("1996726527.69"))
    by_status = {x.payment_status: x.line_items for x in E.queries()["dash_payment_status"](wh.spark, SF).collect()}
    assert by_status == {"failed": 3166, "pending": 30138, "refunded": 3233, "success": 3031}
    assert E.queries()["average_order_value"](wh.spark, SF).first()[0] == pytest.approx(153712.58873672056, rel=1e-15)


def test_revenue_by_year_and_uncategorized(wh):
    years = {r.year: r.rev for r in wh.fact.join(wh.dim("date"), "date_key").groupBy("year")
             .agg(F.sum("total_amount").alias("rev")).collect()}
    assert years == {1995: Decimal("305403108.70"), 1996: Decimal("303612350.99"), 1997: Decimal("294427557.43"),
                     1998: Decimal("302927954.85"), 1999: Decimal("301938013.04"), 2000: Decimal("317290164.75"),
                     2001: Decimal("171127377.93")}
    cats = {r.category: r.revenue for r in E.queries()["dash_revenue_by_category"](wh.spark, SF).collect()}
    assert cats["Uncategorized"] == Decimal("221173998.41")


def test_orphans_and_calendar(wh):
    checks = {r.check_name: r.failed_rows for r in E.queries()["quality_checks"](wh.spark, SF).collect()}
    assert checks["orphan_orders_missing_customer"] == 739 and checks["orphan_order_items"] == 857
    tests = {r.test_name: r.failures for r in E.queries()["model_tests"](wh.spark, SF).collect()}
    assert tests["assert_valid_orders"] == 1710
    assert E.queries()["narrow_calendar_fact_rows"](wh.spark, SF).first().fact_rows == 30184
    assert E.queries()["latest_payment"](wh.spark, SF).count() == 4760
    ico = E.queries()["int_customer_orders"](wh.spark, SF)
    known = wh.raw("customers").select("customer_id")
    with_orders = ico.join(known, "customer_id")
    assert with_orders.count() == 1440 and with_orders.filter(F.col("total_orders") > 1).count() == 1437
