"""Declarative model tests (T-1 ... T-7), compiled to few scans.

A generic test is (model, column, kind, args, severity). The tests compile to
one Spark SQL statement, as dbt compiles tests to SQL. Per model, all
``not_null``, ``accepted_values`` and ``relationships`` tests become ONE
aggregate over one scan (relationships as left joins against the parent's
distinct keys, broadcast only when proven small, those of a statement together;
otherwise a shuffle anti join); the ``unique`` tests of all models share one group-by per type of key. Failure
counts: rows for not_null / relationships, duplicated values for unique,
distinct offending values for accepted_values.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillroll.operators.joins import broadcast_limit, fits_broadcast
from tillroll.schemas import VALID_PAYMENT_STATUSES


@dataclass(frozen=True)
class ModelTest:
    model: str
    column: str
    kind: str  # not_null | unique | relationships | accepted_values
    to: tuple[str, str] | None = None
    values: tuple[str, ...] | None = None
    severity: str = "error"

    @property
    def name(self) -> str:
        if self.kind == "relationships":
            return f"relationships_{self.model}_{self.column}__{self.to[1]}__{self.to[0]}"
        return f"{self.kind}_{self.model}_{self.column}"


def _nn_u(model: str, col: str) -> list[ModelTest]:
    return [ModelTest(model, col, "not_null"), ModelTest(model, col, "unique")]


# Fixed values that must equal the reference's model tests (staging + marts).
GENERIC_TESTS: tuple[ModelTest, ...] = tuple(
    _nn_u("stg_customers", "customer_id")
    + [ModelTest("stg_customers", "email", "not_null")]
    + _nn_u("stg_products", "product_id")
    + [ModelTest("stg_products", "price", "not_null")]
    + _nn_u("stg_stores", "store_id")
    + _nn_u("stg_orders", "order_id")
    + [
        ModelTest("stg_orders", "customer_id", "not_null"),
        ModelTest("stg_orders", "customer_id", "relationships", to=("stg_customers", "customer_id")),
    ]
    + _nn_u("stg_order_items", "order_item_id")
    + [
        ModelTest("stg_order_items", "order_id", "not_null"),
        ModelTest("stg_order_items", "order_id", "relationships", to=("stg_orders", "order_id"), severity="warn"),
        ModelTest("stg_order_items", "product_id", "not_null"),
        ModelTest("stg_order_items", "product_id", "relationships", to=("stg_products", "product_id")),
        ModelTest("stg_order_items", "quantity", "not_null"),
    ]
    + _nn_u("stg_payments", "payment_id")
    + [
        ModelTest("stg_payments", "order_id", "not_null"),
        ModelTest("stg_payments", "order_id", "relationships", to=("stg_orders", "order_id"), severity="warn"),
        ModelTest("stg_payments", "payment_status", "accepted_values", values=VALID_PAYMENT_STATUSES),
    ]
    + _nn_u("dim_customer", "customer_key") + _nn_u("dim_customer", "customer_id")
    + _nn_u("dim_product", "product_key") + _nn_u("dim_product", "product_id")
    + _nn_u("dim_store", "store_key") + _nn_u("dim_store", "store_id")
    + _nn_u("dim_date", "date_key") + _nn_u("dim_date", "full_date")
    + _nn_u("fact_sales", "sale_id")
    + [
        ModelTest("fact_sales", "order_item_id", "not_null"),
        ModelTest("fact_sales", "customer_key", "not_null"),
        ModelTest("fact_sales", "customer_key", "relationships", to=("dim_customer", "customer_key")),
        ModelTest("fact_sales", "product_key", "not_null"),
        ModelTest("fact_sales", "product_key", "relationships", to=("dim_product", "product_key")),
        ModelTest("fact_sales", "date_key", "not_null"),
        ModelTest("fact_sales", "date_key", "relationships", to=("dim_date", "date_key")),
        ModelTest("fact_sales", "quantity", "not_null"),
        ModelTest("fact_sales", "total_amount", "not_null"),
    ]
)

SINGULAR = ("assert_fact_grain_unique", "assert_positive_revenue", "assert_valid_orders")


def _q(name: str) -> str:
    return f"`{name}`"


def _lit(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _rows_sql(model: str, items: list[tuple[ModelTest, str]], source: str, hints: list[str]) -> str:
    """One aggregate over one scan, unpivoted to one row per test."""
    aggs = ", ".join(f"CAST({expr} AS BIGINT) AS f{j}" for j, (_, expr) in enumerate(items))
    stack = ", ".join(
        f"{_lit(t.column)}, {_lit(t.name)}, {_lit(t.severity)}, f{j}" for j, (t, _) in enumerate(items)
    )
    hint = f"/*+ BROADCAST({', '.join(hints)}) */ " if hints else ""
    return (
        f"SELECT {_lit(model)} AS model, column_name, test_name, severity, failures FROM ("
        f"SELECT stack({len(items)}, {stack}) AS (column_name, test_name, severity, failures) "
        f"FROM (SELECT {hint}{aggs} FROM {source}) AS a) AS s"
    )


def _compile(models: Mapping[str, DataFrame], view: Mapping[str, str], tests, singular: bool) -> str:
    by_model: dict[str, list[ModelTest]] = {}
    for t in tests:
        by_model.setdefault(t.model, []).append(t)
    parts: list[str] = []
    # the driver may hold the keys of all parents at once
    parents = {t.to for t in tests if t.kind == "relationships"}
    share = broadcast_limit(next(iter(models.values()))) // max(1, len(parents))
    for model, ts in by_model.items():
        v = view[model]
        # ONE scan per model for not_null / accepted_values / relationships
        source, hints, items = f"{v} AS c", [], []
        for i, t in enumerate(ts):
            col = f"c.{_q(t.column)}"
            if t.kind == "not_null":
                items.append((t, f"count_if({col} IS NULL)"))
            elif t.kind == "accepted_values":
                vals = ", ".join(_lit(x) for x in t.values)
                items.append((t, f"count(DISTINCT CASE WHEN {col} IS NOT NULL AND {col} NOT IN ({vals}) THEN {col} END)"))
            elif t.kind == "relationships":
                pm, pf = t.to
                # parent rows bound its distinct keys: prove the cheaper plan small
                if fits_broadcast(models[pm].select(pf), share):
                    alias = f"p{i}"
                    source += (f" LEFT JOIN (SELECT DISTINCT {_q(pf)} AS k, true AS hit FROM {view[pm]}) AS {alias}"
                               f" ON {col} = {alias}.k")
                    hints.append(alias)
                    items.append((t, f"count_if({col} IS NOT NULL AND {alias}.hit IS NULL)"))
                else:  # parent too big to broadcast: shuffle anti join, whatever its files' bytes
                    parts.append(
                        f"SELECT /*+ MERGE(p) */ {_lit(model)} AS model, {_lit(t.column)} AS column_name, {_lit(t.name)} AS test_name, "
                        f"{_lit(t.severity)} AS severity, count(*) AS failures FROM {v} AS c "
                        f"LEFT ANTI JOIN {view[pm]} AS p ON {col} = p.{_q(pf)} WHERE {col} IS NOT NULL"
                    )
        if items:
            parts.append(_rows_sql(model, items, source, hints))
    # the unique tests of all models in one shuffle per type of key: (test id, key)
    # pairs, integers as longs, dates as dates, all else as text
    uniques = [t for t in tests if t.kind == "unique"]
    if uniques:
        by_type: dict[str, dict[str, list[tuple[int, ModelTest]]]] = {}
        for gid, t in enumerate(uniques):
            kind = _key_type(models[t.model].schema[t.column].dataType)
            by_type.setdefault(kind, {}).setdefault(t.model, []).append((gid, t))
        repeated = " UNION ALL ".join(
            f"SELECT p.i, count(*) AS n FROM (SELECT p.i, p.v FROM (" + " UNION ALL ".join(
                "SELECT explode(array(" + ", ".join(
                    f"named_struct('i', {gid}, 'v', CAST({_q(t.column)} AS {kind}))" for gid, t in items
                ) + f")) AS p FROM {view[m]}"
                for m, items in by_m.items()
            ) + ") AS e WHERE p.v IS NOT NULL GROUP BY p.i, p.v HAVING count(*) > 1) AS p GROUP BY p.i"
            for kind, by_m in by_type.items()
        )
        meta = ", ".join(
            f"({gid}, {_lit(t.model)}, {_lit(t.column)}, {_lit(t.name)}, {_lit(t.severity)})"
            for gid, t in enumerate(uniques)
        )
        parts.append(
            f"SELECT m.model, m.column_name, m.test_name, m.severity, coalesce(d.n, 0) AS failures "
            f"FROM (VALUES {meta}) AS m(i, model, column_name, test_name, severity) LEFT JOIN ({repeated}) AS d ON m.i = d.i"
        )
    if singular:
        f, o = view["fact_sales"], view["stg_orders"]

        def one(name: str, column: str, q: str) -> str:
            return (f"SELECT 'fact_sales' AS model, {_lit(column)} AS column_name, {_lit(name)} AS test_name, "
                    f"'error' AS severity, failures FROM ({q}) AS x")

        parts += [
            one("assert_fact_grain_unique", "order_id,order_item_id",
                f"SELECT count(*) AS failures FROM (SELECT order_id, order_item_id FROM {f} "
                f"GROUP BY order_id, order_item_id HAVING count(*) > 1) AS g"),
            one("assert_positive_revenue", "total_amount", f"SELECT count_if(total_amount < 0) AS failures FROM {f}"),
            # orders x fact: distinct fact order ids first (one row per order)
            one("assert_valid_orders", "order_id",
                f"SELECT /*+ MERGE(fo) */ count(*) AS failures FROM {o} AS o LEFT ANTI JOIN (SELECT DISTINCT order_id FROM {f}) AS fo "
                f"ON o.order_id = fo.order_id"),
        ]
    body = " UNION ALL ".join(f"SELECT model, column_name, test_name, severity, CAST(failures AS BIGINT) AS failures "
                              f"FROM ({p}) AS u{k}" for k, p in enumerate(parts))
    return (f"SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END "
            f"AS status FROM ({body}) AS r")


def _key_type(kind: T.DataType) -> str:
    if isinstance(kind, T.IntegralType):
        return "BIGINT"
    return "DATE" if isinstance(kind, T.DateType) else "STRING"


def run_model_tests(models: Mapping[str, DataFrame], tests=GENERIC_TESTS, singular: bool = True) -> DataFrame:
    """(model, column_name, test_name, severity, failures, status) per test.

    The declarative tests compile to ONE Spark SQL statement over temporary
    views of the models (dropped again once the statement is analysed)."""
    tests = tuple(tests)
    needed = {t.model for t in tests} | {t.to[0] for t in tests if t.kind == "relationships"}
    if singular:
        needed |= {"fact_sales", "stg_orders"}
    spark = next(iter(models.values())).sparkSession
    tag = uuid.uuid4().hex[:10]
    view = {m: f"_mt_{tag}_{m}" for m in needed}
    for m, v in view.items():
        models[m].createOrReplaceTempView(v)
    try:
        return spark.sql(_compile(models, view, tests, singular))
    finally:
        for v in view.values():
            spark.catalog.dropTempView(v)


def test_groups(tests=GENERIC_TESTS) -> dict[str, tuple[ModelTest, ...]]:
    """Tests per model: independent units that can run as concurrent jobs."""
    groups: dict[str, list[ModelTest]] = {}
    for t in tests:
        groups.setdefault(t.model, []).append(t)
    return {m: tuple(ts) for m, ts in groups.items()}


def run_singular_tests(models: Mapping[str, DataFrame]) -> DataFrame:
    return run_model_tests(models, (), singular=True)
