"""Row validation as one tagged projection (V-1 ... V-10).

A rule is a named predicate. ``tag`` evaluates every rule of a batch in a
single projection and adds ``_reasons`` (array of the failed rules' texts, in
rule order) and ``_reason`` (the first one). A row is valid iff ``_reasons`` is
empty. Null handling follows the reference: a predicate that is null fails, so
``coalesce(pred, false)`` is applied to every rule.

Evaluating all rules at once gives the same split as the reference's chain
("each rule sees only the survivors of the previous one"): a row survives the
chain iff it passes every rule, and the first failing rule is the one whose
reject list it would have landed in.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.schemas import LINE_MONEY, TableSpec

REASONS = "_reasons"
REASON = "_reason"


@dataclass(frozen=True, eq=False)
class Rule:
    reason: str
    ok: Column

    def failed(self) -> Column:
        return ~F.coalesce(self.ok, F.lit(False))


# Fixed values that must equal the reference's rule messages.
def positive(column: str = "quantity") -> Rule:
    return Rule(f"{column} must be greater than 0", F.col(column) > 0)


def non_negative(column: str) -> Rule:
    return Rule(f"{column} must not be negative", F.col(column) >= 0)


def accepted_values(column: str, allowed: Iterable[str]) -> Rule:
    allowed = sorted(set(allowed))
    return Rule(f"{column} must be one of {allowed}", F.col(column).isin(allowed))


def valid_date(column: str) -> Rule:
    from tillroll.functions.coerce import parse_date

    return Rule(f"{column} is not a valid date", parse_date(column).isNotNull())


def discount_not_exceed_line_value(
    quantity_column: str = "quantity",
    unit_price_column: str = "unit_price",
    discount_column: str = "discount",
) -> Rule:
    return Rule(
        f"{discount_column} must not exceed {quantity_column} * {unit_price_column}",
        F.col(discount_column) <= F.col(quantity_column) * F.col(unit_price_column),
    )


def line_value_in_range(
    quantity_column: str = "quantity",
    unit_price_column: str = "unit_price",
    discount_column: str = "discount",
    dtype: str = LINE_MONEY,
) -> Rule:
    """The line's value fits the type that the models keep it in."""
    value = F.col(quantity_column) * F.col(unit_price_column) - F.coalesce(F.col(discount_column), F.lit(0))
    return Rule(f"{quantity_column} * {unit_price_column} is out of range", value.try_cast(dtype).isNotNull())


def not_null(column: str, reason: str | None = None) -> Rule:
    return Rule(reason or f"null in required column {column}", F.col(column).isNotNull())


def required_rules(spec: TableSpec, reason: str | None = None) -> list[Rule]:
    return [not_null(c, reason) for c in spec.required_columns]


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """V-1: required columns absent from the batch (a driver-side schema check)."""
    return sorted(set(required) - set(df.columns))


def tag(df: DataFrame, rules: Sequence[Rule], batch_reason: str | None = None) -> DataFrame:
    """Add ``_reasons``/``_reason``. ``batch_reason`` rejects every row (V-1)."""
    if batch_reason is not None:
        reasons = F.array(F.lit(batch_reason))
    elif rules:
        reasons = F.array_compact(
            F.array(*[F.when(r.failed(), F.lit(r.reason)) for r in rules])
        )
    else:
        reasons = F.array().cast("array<string>")
    return df.withColumn(REASONS, reasons).withColumn(REASON, F.get(F.col(REASONS), 0))


def is_valid() -> Column:
    return F.size(F.col(REASONS)) == 0


def split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without tags, rejected rows with tags)."""
    valid = tagged.filter(is_valid()).drop(REASONS, REASON)
    rejected = tagged.filter(~is_valid())
    return valid, rejected


def check(df: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame, str]:
    """The reference's rule contract: (valid, invalid, reason)."""
    bad = rule.failed()
    return df.filter(~bad), df.filter(bad), rule.reason


def check_positive_quantity(df: DataFrame, column: str = "quantity"):
    return check(df, positive(column))


def check_non_negative(df: DataFrame, column: str):
    return check(df, non_negative(column))


def check_accepted_values(df: DataFrame, column: str, allowed: Iterable[str]):
    return check(df, accepted_values(column, allowed))


def check_valid_date(df: DataFrame, column: str):
    return check(df, valid_date(column))


def check_discount_not_exceed_line_value(
    df: DataFrame,
    quantity_column: str = "quantity",
    unit_price_column: str = "unit_price",
    discount_column: str = "discount",
):
    return check(df, discount_not_exceed_line_value(quantity_column, unit_price_column, discount_column))


def check_no_duplicate_ids(df: DataFrame, id_column: str, order: Sequence[str | Column]):
    """V-7: later copies of an id are invalid; ``order`` defines "first".

    The first position per id comes from an aggregate (map-side combined, so a
    hot id costs one row per task), then a null-safe join marks the copies.
    """
    seq = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    marked = df.withColumn("_dup_seq", seq)
    first = marked.groupBy(id_column).agg(F.min("_dup_seq").alias("_first_seq"))
    joined = marked.join(
        first.withColumnRenamed(id_column, "_dup_id"),
        marked[id_column].eqNullSafe(F.col("_dup_id")),
        "inner",
    )
    keep = F.col("_dup_seq") == F.col("_first_seq")
    cols = df.columns
    return (
        joined.filter(keep).select(*cols),
        joined.filter(~keep).select(*cols),
        f"duplicate {id_column}",
    )


CORRUPT_COLUMN = "_corrupt_record"


@dataclass(eq=False)
class ValidationResult:
    """Schema validation of one batch (V-1/V-2): lazy row splits plus the
    error texts, which need one small aggregate and are computed on demand."""

    table_name: str
    valid_rows: DataFrame
    invalid_rows: DataFrame
    missing: list[str]
    required: list[str]

    @property
    def errors(self) -> list[str]:
        if self.missing:
            return [f"Missing required columns: {self.missing}"]
        n = self.invalid_rows.count()
        return [f"{n} row(s) have null values in required columns {self.required}"] if n else []

    @property
    def is_valid(self) -> bool:
        return not self.errors


def validate_schema(df: DataFrame, spec: TableSpec) -> ValidationResult:
    """Required columns present and non-null; invalid rows keep their reasons."""
    missing = missing_columns(df, spec.required_columns)
    present = [c for c in spec.required_columns if c in df.columns]
    tagged = tag(df, [not_null(c) for c in present], f"Missing required columns: {missing}" if missing else None)
    valid, invalid = split(tagged)
    return ValidationResult(spec.name, valid, invalid, missing, present)
