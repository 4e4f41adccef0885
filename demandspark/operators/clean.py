"""Typing, validity filters and quarantine of raw events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import MONEY, PRICE


def type_events(df: DataFrame) -> DataFrame:
    """Event columns with their target types: trimmed names, flag false when missing.

    Values that cannot be read become null, so that the validity rules see them.
    """
    return df.select(
        F.col("id").cast("bigint").alias("id"),
        F.col("event_date").try_cast("date").alias("event_date"),
        F.trim("product_category").alias("product_category"),
        F.trim("store_region").alias("store_region"),
        F.col("units_sold").try_cast("int").alias("units_sold"),
        F.col("revenue").try_cast(MONEY).alias("revenue"),
        F.col("avg_unit_price").try_cast(PRICE).alias("avg_unit_price"),
        F.coalesce(F.col("promotion_flag").try_cast("boolean"), F.lit(False)).alias("promotion_flag"),
        "ingested_at")


def _faults(rules: str) -> dict[str, Column]:
    """Reason -> condition under which a row breaks the rule."""
    c = F.col
    staging = {
        "null_event_date": c("event_date").isNull(),
        "null_product_category": c("product_category").isNull(),
        "null_units_sold": c("units_sold").isNull(),
        "negative_units_sold": F.coalesce(c("units_sold") < 0, F.lit(False)),
    }
    if rules == "staging":
        return staging
    if rules == "silver":
        return staging | {
            "null_store_region": c("store_region").isNull(),
            "null_revenue": c("revenue").isNull(),
            "negative_revenue": F.coalesce(c("revenue") < 0, F.lit(False)),
            "null_avg_unit_price": c("avg_unit_price").isNull(),
        }
    raise ValueError(f"rules must be 'staging' or 'silver', not {rules!r}")


def _any(conditions: list[Column]) -> Column:
    found = F.lit(False)
    for condition in conditions:
        found = found | condition
    return found


def is_valid(rules: str = "staging") -> Column:
    """Whether a row meets the ``staging`` or the stricter ``silver`` rules."""
    return ~_any(list(_faults(rules).values()))


def clean(df: DataFrame, rules: str = "staging") -> DataFrame:
    """Keep the rows that meet the ``staging`` or the stricter ``silver`` rules."""
    return df.filter(is_valid(rules))


def rejects(df: DataFrame, rules: str = "staging") -> DataFrame:
    """The rows ``clean`` drops, with the list of reasons."""
    faults = _faults(rules)
    reasons = F.array_compact(F.array(*[F.when(bad, F.lit(why)) for why, bad in faults.items()]))
    return df.filter(_any(list(faults.values()))).withColumn("reasons", reasons)


def stg_rollups(df: DataFrame) -> DataFrame:
    """Rollups with a true date and a trimmed category; other columns pass through."""
    return df.withColumns({"event_date": F.to_date("event_date"), "product_category": F.trim("product_category")})
