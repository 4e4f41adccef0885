"""Incremental maintenance of the lake tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import nullcontext
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EVENT_KEY, RECENCY
from ..session import staged
from ..sources.lake import read_months, replace_partitions
from .dedupe import dedupe_latest, fixed_width, packed_order

MONTH = "event_month"


def new_rows(source: DataFrame, bronze: DataFrame, id_cols: Sequence[str] = ("id", "ingested_at")) -> DataFrame:
    """Source rows whose identity is not in bronze yet.

    Bronze identities are unique or nearly so and are not aggregated first: a plain shuffle on
    both sides lets AQE split an identity the source repeats very often.
    """
    return source.join(bronze.select(*id_cols), list(id_cols), "left_anti")


def stamps(batch_id: str, source: str | None = None, layer: str = "bronze") -> dict[str, Column]:
    """Audit columns: batch, time and, if given, source."""
    columns = {f"_{layer}_batch_id": F.lit(batch_id), f"_{layer}_at": F.current_timestamp()}
    return columns | ({"_source": F.lit(source)} if source is not None else {})


def stamp(df: DataFrame, batch_id: str, source: str | None = None, layer: str = "bronze") -> DataFrame:
    """``df`` with the audit columns of a batch."""
    return df.withColumns(stamps(batch_id, source, layer))


def _prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*keys, F.struct(*[c for c in df.columns if c not in keys]).alias(prefix))


def _matched(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str], unique: bool) -> DataFrame:
    """Target and latest update side by side, one row per key. Null key parts are equal to each other."""
    latest = updates.select(*target.columns) if unique else dedupe_latest(updates, keys, order, target.columns)
    new = _prefixed(latest, keys, "_new").select("_new", *[F.col(k).alias(f"_key_{k}") for k in keys])
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys))
    joined = _prefixed(target, keys, "_old").join(new, same, "full_outer")
    return joined.select(*[F.coalesce(k, f"_key_{k}").alias(k) for k in keys], "_old", "_new")


def _newer(order: Sequence[str]) -> Column:
    new, old = (F.struct(*[F.col(f"{side}.{c}") for c in order]) for side in ("_new", "_old"))
    return F.col("_old").isNotNull() & F.col("_new").isNotNull() & (new > old)


def _merged(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame | None:
    """``_upserted`` as one aggregate over both sides: no join, null key parts meet by themselves, a key of very many
    updates is one row per task. None if the columns are not all of fixed width, which such an aggregate needs."""
    columns = target.columns
    both = target.withColumn("_side", F.lit(0)).unionAll(updates.select(*columns).withColumn("_side", F.lit(1)))
    packed, values = packed_order(both, order), [c for c in columns if c not in keys]
    if packed is None or not fixed_width(both, values):
        return None
    ordered = both.select(*columns, "_side", packed.alias("_order"))
    side = [F.max(F.when(F.col("_side") == k, F.col("_order"))) for k in (0, 1)]
    old, new = F.col("_old"), F.col("_new")
    picked = ordered.groupBy(*keys).agg(side[0].alias("_old"), side[1].alias("_new"),
                                        *[F.max_by(c, F.when(F.col("_side") == k, F.col("_order"))).alias(f"_{k}_{c}") for c in values for k in (0, 1)])
    change = F.when(old.isNull(), "inserted").when(new.isNull(), "kept").when(new > old, "updated").otherwise("unchanged")
    marked = picked.withColumn("_change", change)
    taken = F.col("_change").isin("inserted", "updated")
    return marked.select(*[F.col(c) if c in keys else F.when(taken, F.col(f"_1_{c}")).otherwise(F.col(f"_0_{c}")).alias(c) for c in columns], "_change")


def _upserted(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str], unique: bool = False) -> DataFrame:
    """The upserted table with what happened to each row (``_change``). ``unique``: the updates have one row per key already."""
    merged = _merged(target, updates, keys, order)
    if merged is not None:
        return merged
    change = F.when(F.col("_old").isNull(), "inserted").when(F.col("_new").isNull(), "kept") \
        .when(_newer(order), "updated").otherwise("unchanged")
    joined = _matched(target, updates, keys, order, unique).withColumn("_change", change)
    row = F.when(F.col("_change").isin("inserted", "updated"), F.col("_new")).otherwise(F.col("_old"))
    return joined.withColumn("_row", row).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in target.columns], "_change")


def _numbers() -> list[Column]:
    def number(*kinds: str) -> Column:
        return F.count_if(F.col("_change").isin(*kinds))

    return [number("inserted", "updated", "unchanged").alias("source_rows"), number("inserted").alias("inserted"),
            number("updated").alias("updated"), number("unchanged").alias("unchanged")]


def _counts(changes: DataFrame) -> DataFrame:
    return changes.agg(*_numbers())


def upsert_newer(target: DataFrame, updates: DataFrame, keys: Sequence[str] = EVENT_KEY,
                 order: Sequence[str] = RECENCY) -> DataFrame:
    """The target after an upsert: new keys inserted, a key updated only by a strictly newer row,
    everything else unchanged, nothing deleted. ``target`` has one row per key."""
    return _upserted(target, updates, keys, order).drop("_change")


def upsert_metrics(target: DataFrame, updates: DataFrame, keys: Sequence[str] = EVENT_KEY,
                   order: Sequence[str] = RECENCY) -> DataFrame:
    """One row: what ``upsert_newer`` would do. All zero changes means the batch is a replay."""
    slim = list(dict.fromkeys([*keys, *order]))
    return _counts(_upserted(target.select(*slim), updates.select(*slim), keys, order))


def merge_into(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str] = EVENT_KEY,
               order: Sequence[str] = RECENCY, date: str = "event_date",
               on_change: Callable[[DataFrame], None] | None = None, stamps: Mapping[str, Column] | None = None,
               unique: bool = False) -> dict[str, int]:
    """Upsert a batch into a table partitioned by month; only months of the batch are read and
    rewritten. Returns the metrics of the merge; a replayed batch changes and writes nothing.

    The result is complete in the shared folder before any partition is replaced, and running
    an interrupted merge again gives the same table. ``on_change`` gets the inserted and updated rows
    before the table is touched. ``stamps`` are audit columns of the rows the batch writes; others keep theirs.
    ``unique``: the updates are stored rows with one row per key; they are neither deduplicated nor stored again.
    """
    added = {**(stamps or {}), MONTH: F.trunc(date, "MM")}
    with nullcontext(updates.withColumns(added)) if unique else staged(dedupe_latest(updates, keys, order).withColumns(added), "batch") as batch:
        held = read_months(spark, path, MONTH, months_in(batch))
        touched = batch.limit(0) if held is None else held.select(*batch.columns)
        with staged(_upserted(touched, batch, keys, order, unique=True), "merged") as merged:
            taken = F.col("_change").isin("inserted", "updated")
            *counts, changed = merged.agg(*_numbers(), F.collect_set(F.when(taken, F.col(MONTH))).alias("changed")).first()  # a value per month
            if changed:
                if on_change:
                    on_change(merged.filter(taken).drop("_change"))
                replace_partitions(merged.filter(F.col(MONTH).isin(changed)).drop("_change"), path, [MONTH])
    return dict(zip(("source_rows", "inserted", "updated", "unchanged"), counts))


def months_in(df: DataFrame) -> list:
    """The months that occur: at most one value per calendar month, whatever the number of rows."""
    return [r[0] for r in df.select(MONTH).distinct().collect()]


def as_of(bronze: DataFrame, batch: int, batch_col: str = "batch_seq", keys: Sequence[str] = EVENT_KEY,
          order: Sequence[str] = RECENCY) -> DataFrame:
    """State after batch number ``batch``: the append-only history up to it, latest row per key."""
    return dedupe_latest(bronze.filter(F.col(batch_col) <= batch).drop(batch_col), keys, order)


def snapshot_diff(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows one snapshot has more often than the other: the row, its ``side`` and the surplus ``copies``.

    One signed count per distinct row instead of two multiset differences: one shuffle, copies
    are combined before it, and a row repeated very often stays one row of the result.
    """
    columns = list(columns or a.columns)
    signed = a.select(*columns, F.lit(1).alias("_n")).unionAll(b.select(*columns, F.lit(-1).alias("_n")))
    net = signed.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter(F.col("_n") != 0)
    return net.select(*columns, F.when(F.col("_n") > 0, "left").otherwise("right").alias("side"),
                      F.abs("_n").alias("copies"))
