"""Duplicate removal on a natural key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EVENT_KEY, RECENCY


_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
_LOWEST = -(1 << 62)


def packed_order(df: DataFrame, order: Sequence[str]) -> Column | None:
    """A time and an id as one number that sorts like both, nulls first; None for another order."""
    kinds = [df.schema[c].dataType for c in order]
    if len(kinds) != 2 or not isinstance(kinds[1], T.IntegralType):
        return None
    when, number = (F.col(c) for c in order)
    if isinstance(kinds[0], T.TimestampType):
        micros = F.unix_micros(when)
    elif isinstance(kinds[0], T.TimestampNTZType):
        micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), when)
    else:
        return None
    exact = lambda value: F.lit(str(value)).cast("decimal(20,0)")
    high = F.coalesce(micros.cast("decimal(20,0)"), exact(_LOWEST)) * exact(1 << 64)
    low = F.coalesce(number.cast("decimal(20,0)") + exact((1 << 63) + 1), exact(0))
    return (high + low).cast("decimal(38,0)")


def fixed_width(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether hash aggregation can keep all ``columns`` in place."""
    return all(isinstance(df.schema[c].dataType, _FIXED_WIDTH) for c in columns)


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick, columns) -> DataFrame:
    """Columns of fixed width are picked one by one by a packed order, which hash aggregation can update
    in place; equal orders are met in the same sequence by each of them. Others are picked as a struct."""
    kept = list(columns or df.columns)
    wanted = [c for c in kept if c not in keys]
    packed = packed_order(df, order)
    if packed is not None and wanted and fixed_width(df, wanted):
        ordered = df.select(*dict.fromkeys([*keys, *wanted]), packed.alias("_order"))
        return ordered.groupBy(*keys).agg(*[pick(c, "_order").alias(c) for c in wanted]).select(*kept)
    best = pick(F.struct(*wanted), F.struct(*order)).alias("_row")
    chosen = df.groupBy(*keys).agg(best)
    return chosen.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in kept])


def dedupe_latest(df: DataFrame, keys: Sequence[str] = EVENT_KEY, order: Sequence[str] = RECENCY,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """Keep the row with the highest ``order`` per key (latest wins).

    An aggregate, not a ranked window: every task reduces its rows to one per key before the
    shuffle, so a key with very many copies costs one row per task. ``columns`` limits what
    is carried along.
    """
    return _one_per_key(df, keys, order, F.max_by, columns)


def latest_by_rule(df: DataFrame, rules: Mapping[str, Column], values: Sequence[str], keys: Sequence[str] = EVENT_KEY,
                   order: Sequence[str] = RECENCY) -> DataFrame:
    """Per key and rule the ``values`` of the latest row that meets the rule, as ``<rule>_<value>``, and ``<rule>_n``, how many do.

    One aggregate for all rules: each picks its own latest row, so the rows are read and shuffled once.
    """
    packed = packed_order(df, order)
    when = F.struct(*order) if packed is None else packed
    aggregates = []
    for name, condition in rules.items():
        held = F.when(condition, when)
        aggregates += [F.count_if(condition).alias(f"{name}_n"), *[F.max_by(c, held).alias(f"{name}_{c}") for c in values]]
    return df.groupBy(*keys).agg(*aggregates)


def keep_first(df: DataFrame, keys: Sequence[str] = EVENT_KEY, order: Sequence[str] = RECENCY) -> DataFrame:
    """Keep the row with the lowest ``order`` per key."""
    return _one_per_key(df, keys, order, F.min_by, None)


def dedupe_first(new: DataFrame, existing: DataFrame, keys: Sequence[str] = EVENT_KEY,
                 order: Sequence[str] = RECENCY) -> DataFrame:
    """Insert-ignore: new rows whose key is not stored yet, the first arrival of each key.

    Both sides have one row per key before they meet, so no key is hot in the join. Null key parts
    are equal to each other.
    """
    known = existing.select(*[F.col(k).alias(f"_known_{k}") for k in keys]).distinct()
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys))
    return keep_first(new, keys, order).join(known, same, "left_anti")


def duplicate_stats(df: DataFrame, keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """One row: rows, distinct keys and surplus rows, counted in one pass."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"), F.count("*").alias("distinct_keys")) \
        .withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_keys"))


def duplicate_groups(df: DataFrame, keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_records")).filter(F.col("n_records") > 1)
