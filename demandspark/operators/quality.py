"""Data-quality checks, write gate and calendar completeness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import EVENT_KEY, PRICE_RANGE, REVENUE_RANGE, UNITS_RANGE
from ..session import materialize
from .marts import series_span
from .scalars import value_of


class Check(NamedTuple):
    """A named check: a row condition, or a key that must be unique."""

    name: str
    failed: Column | None = None
    key: tuple[str, ...] = ()


def not_null(col: str) -> Check:
    return Check(f"not_null({col})", F.col(col).isNull())


def in_set(col: str, values: Sequence[str]) -> Check:
    return Check(f"in_set({col})", F.coalesce(~F.col(col).isin(*values), F.lit(False)))


def between(col: str, low, high) -> Check:
    return Check(f"between({col})", F.coalesce(~F.col(col).between(low, high), F.lit(False)))


def unique_key(*cols: str) -> Check:
    return Check(f"unique({','.join(cols)})", key=cols)


def sales_checks(categories: Sequence[str], regions: Sequence[str]) -> list[Check]:
    """The nine expectations on sales events."""
    return [not_null("event_date"), not_null("product_category"), in_set("product_category", categories),
            in_set("store_region", regions), between("units_sold", *UNITS_RANGE),
            between("revenue", *REVENUE_RANGE), between("avg_unit_price", *PRICE_RANGE),
            not_null("promotion_flag"), unique_key(*EVENT_KEY)]


def _as_rows(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row of counts (columns c0, c1, ...) -> one row per check."""
    entries = [F.struct(F.lit(i).alias("position"), F.lit(c.name).alias("check_name"),
                        F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("bigint").alias("failed_rows"))
               for i, c in enumerate(checks)]
    rows = counts.select(F.inline(F.array(*entries)))
    return rows.withColumn("status", F.when(F.col("failed_rows") == 0, "PASS").otherwise("FAIL"))


def run_suite(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks as rows (position, check_name, failed_rows, status).

    Row checks and the first key check share one scan: rows are counted per key, with the
    failures of each row check summed beside the count, then totalled. Each further key check
    adds one pass. A key check fails every row of a repeated key; rows whose key is null throughout are left out of it.
    """
    row_checks = [(i, c) for i, c in enumerate(checks) if not c.key]
    key_checks = [(i, c) for i, c in enumerate(checks) if c.key]
    failures = [F.count_if(c.failed).alias(f"c{i}") for i, c in row_checks]

    def repeated(i: int, key: Sequence[str]) -> Column:
        named = F.coalesce(*[F.col(c).cast("string") for c in key]).isNotNull()
        return F.sum(F.when((F.col("_n") > 1) & named, F.col("_n")).otherwise(0)).alias(f"c{i}")

    if not key_checks:
        return _as_rows(df.agg(*failures), checks)
    (first, check), *others = key_checks
    totals = df.groupBy(*check.key).agg(F.count("*").alias("_n"), *failures) \
        .agg(repeated(first, check.key), *[F.sum(f"c{i}").alias(f"c{i}") for i, _ in row_checks])
    for i, other in others:
        one = df.groupBy(*other.key).agg(F.count("*").alias("_n")).agg(repeated(i, other.key))
        totals = totals.withColumn(f"c{i}", value_of(one))
    return _as_rows(totals, checks)


def assert_suite(results: DataFrame) -> DataFrame:
    """Gate: raise if any check failed, with the failed names."""
    failed = [r.check_name for r in results.filter(F.col("status") == "FAIL").collect()]
    if failed:
        raise ValueError("failed checks: " + ", ".join(failed))
    return results


def non_empty(df: DataFrame, what: str = "input") -> DataFrame:
    """One row: ``what`` and whether it has rows; at most one row of each partition is read."""
    found = F.count("*") > 0
    return df.select(F.lit(1)).limit(1).agg(F.lit(what).alias("what"), F.when(found, "PASS").otherwise("FAIL").alias("status"))


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Gate: raise on an empty table."""
    if non_empty(df, what).first().status == "FAIL":
        raise ValueError(f"{what} is empty")
    return df


def schema_problems(df: DataFrame, schema: StructType) -> list[str]:
    """Columns that are missing, unknown or of another type than ``schema`` says."""
    expected = {f.name: f.dataType for f in schema.fields}
    found = {f.name: f.dataType for f in df.schema.fields}
    problems = [f"missing column {c}" for c in expected if c not in found]
    problems += [f"unknown column {c}" for c in found if c not in expected]
    problems += [f"column {c} is {found[c].simpleString()}, not {t.simpleString()}"
                 for c, t in expected.items() if c in found and found[c] != t]
    return problems


def constraint_violations(df: DataFrame, not_null_columns: Sequence[str], rules: Mapping[str, str]) -> DataFrame:
    """Rows that break each NOT NULL column and each named rule (a SQL condition), in one pass.

    As in SQL, a rule that evaluates to null is not a violation.
    """
    checks = [Check(f"{c} not null", F.col(c).isNull()) for c in not_null_columns]
    checks += [Check(name, F.coalesce(~F.expr(rule), F.lit(False))) for name, rule in rules.items()]
    return run_suite(df, checks).select(F.col("check_name").alias("rule"), F.col("failed_rows").alias("violations"))


SILVER_NOT_NULL = (*EVENT_KEY, "units_sold", "revenue", "avg_unit_price", "promotion_flag", "id", "ingested_at")
SILVER_RULES = {"units_sold_non_negative": "units_sold >= 0", "revenue_non_negative": "revenue >= 0"}


def assert_constraints(df: DataFrame, schema: StructType, not_null_columns: Sequence[str] = SILVER_NOT_NULL,
                       rules: Mapping[str, str] = SILVER_RULES) -> DataFrame:
    """Write gate: the whole batch is refused if its schema differs or any row breaks a rule."""
    problems = schema_problems(df, schema)
    if not problems:
        broken = constraint_violations(df, not_null_columns, rules).filter(F.col("violations") > 0)
        problems = [f"{r.rule}: {r.violations} rows" for r in broken.collect()]
    if problems:
        raise ValueError("batch refused: " + "; ".join(problems))
    return df


def missing_from(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key is not in ``b``.

    The keys of ``b`` are made distinct and stored first: no key is hot on that side, and both
    inputs of the join are plain shuffles, so AQE can split a key that is hot in ``a`` (it does
    not when an aggregate sits between shuffle and join).
    """
    known = materialize(b.select(*keys).distinct(), "keys")
    return a.join(known, list(keys), "left_anti")


def gap_check(mart: DataFrame) -> DataFrame:
    """Missing days per series; a series is gap-free when there are none."""
    span = series_span(mart).withColumn("missing_days", F.col("span_days") - F.col("n_rows"))
    return span.withColumn("status", F.when(F.col("missing_days") == 0, "PASS").otherwise("FAIL"))


def fill_calendar(series: DataFrame, fill: Mapping[str, int] = {"y": 0}) -> DataFrame:  # noqa: B006 - not mutated
    """Add the missing days between the first and last day of each series.

    Each row is repeated up to the day before the next row of its series: one window over the
    series, no calendar table and no join. ``series`` has one row per series and day.
    """
    next_day = F.lead("ds").over(Window.partitionBy("product_category").orderBy("ds"))
    days = F.sequence("ds", F.coalesce(F.date_sub("_next", 1), F.col("ds")))
    grown = series.withColumn("_next", next_day).withColumn("_day", F.explode(days))
    is_gap = F.col("_day") != F.col("ds")
    values = {c: F.when(is_gap, F.lit(v).cast(series.schema[c].dataType)).otherwise(F.col(c))
              for c, v in fill.items()}
    return grown.select(*[F.col("_day").alias("ds") if c == "ds" else values.get(c, F.col(c)).alias(c)
                          for c in ["ds", "product_category", *fill]])


def missing_days(series: DataFrame) -> DataFrame:
    """The days ``fill_calendar`` would add."""
    next_day = F.lead("ds").over(Window.partitionBy("product_category").orderBy("ds"))
    gaps = series.withColumn("_next", next_day).filter(F.date_diff("_next", "ds") > 1)
    return gaps.select(F.explode(F.sequence(F.date_add("ds", 1), F.date_sub("_next", 1))).alias("ds"),
                       "product_category")
