"""Rollups kept current by deltas.

State of a view, all partitioned by month:

* ``daily``: one row per day and category, re-aggregated only for months in which events changed;
* ``gold``: the rollups; only rows whose windows reach a changed day are computed again;
* ``pending``: the changed days of merges whose refresh is not finished, so that an interrupted refresh is completed
  by the next one.

A changed day moves the rolling means of the 29 days behind it and the weekly growth of the seven rows behind it. To compute
those, 29 days and seven rows ahead are read as well. Usually that is the month before and the month after; a
sparse series whose seven rows lie further away widens the span for its own, and a series that has not had seven rows yet is
looked for in the earlier months of ``daily`` (never in the events).
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.rollups import SERIES, daily_totals, with_trends
from ..operators.upsert import MONTH, merge_into
from ..schemas import DAILY_KEY
from ..session import staged
from ..sources.lake import append_batch, folder_values, read_months, remove_folder, replace_partitions, table_exists

REACH_DAYS, REACH_ROWS = 29, 7
Span = tuple[date, date]  # first and last month of a contiguous piece of the calendar


class Refresh(NamedTuple):
    """What a refresh did: months re-aggregated, spans of daily months read, months of gold rewritten."""

    aggregated: list[date]
    read: list[Span]
    written: list[date]


def _month_of(day: date) -> date:
    return day.replace(day=1)


def _next_month(month: date) -> date:
    return _month_of(month + timedelta(days=31))


def spans_around(months: list[date]) -> list[Span]:
    """The months that windows over ``months`` reach, as separate contiguous spans."""
    spans: list[Span] = []
    for month in sorted(months):
        low = _month_of(month - timedelta(days=REACH_DAYS))
        high = _month_of(_next_month(month) - timedelta(days=1) + timedelta(days=REACH_DAYS))
        spans.append((low, high))
    return _joined(spans)


def _joined(spans: list[Span]) -> list[Span]:
    out: list[Span] = []
    for low, high in sorted(spans):
        if out and low <= _next_month(out[-1][1]):
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _within(spans: list[Span], column: str = MONTH) -> Column:
    return reduce(or_, (F.col(column).between(F.lit(a), F.lit(b)) for a, b in spans))


def _span_number(spans: list[Span]) -> Column:
    number = F.lit(None).cast("int")
    for k, (low, high) in enumerate(spans):
        number = F.when(F.col(MONTH).between(F.lit(low), F.lit(high)), k).otherwise(number)
    return number


def _days(rows: DataFrame) -> DataFrame:
    """Changed days with their months, one row each."""
    return rows.select(*DAILY_KEY).distinct().withColumn(MONTH, F.trunc("event_date", "MM"))


def _in_spans(daily: DataFrame, days: DataFrame, spans: list[Span]) -> DataFrame:
    """Daily rows of the changed series within the spans, marked where they changed and with what lies around them."""
    touched = days.select(SERIES).distinct()
    rows = daily.filter(_within(spans)).join(touched, SERIES, "left_semi").withColumn("_span", _span_number(spans))
    rows = rows.join(days.select(*DAILY_KEY, F.lit(True).alias("_changed")), list(DAILY_KEY), "left")
    rows = rows.withColumn("_series", F.struct(SERIES, "_span"))
    by_date = Window.partitionBy("_series").orderBy("event_date")
    whole = by_date.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.row_number().over(by_date) - 1
    return rows.withColumns({"_before": before, "_after": F.count("*").over(whole) - before - 1})


def _widened(daily: DataFrame, rows: DataFrame, spans: list[Span], available: list[date]) -> list[Span]:
    """The spans, widened to the month of the seventh row ahead of and behind every changed day that lacks it."""
    out = list(spans)
    short = rows.filter("_changed").groupBy(SERIES, "_span").agg(F.min("_before").alias("ahead"), F.min("_after").alias("behind"))
    short = short.filter((F.col("ahead") < REACH_ROWS) | (F.col("behind") < REACH_ROWS))
    for k, (low, high) in enumerate(spans):
        for have, beyond, order in (("ahead", [m for m in available if m < low], F.desc(MONTH)), ("behind", [m for m in available if m > high], F.asc(MONTH))):
            lacking = short.filter((F.col("_span") == k) & (F.col(have) < REACH_ROWS)).select(SERIES, have)
            if not beyond or lacking.isEmpty():
                continue
            outside = daily.filter(F.col(MONTH).between(F.lit(beyond[0]), F.lit(beyond[-1])))
            months = outside.join(lacking, SERIES).groupBy(SERIES, have, MONTH).agg(F.count("*").alias("n"))
            met = F.sum("n").over(Window.partitionBy(SERIES).orderBy(order)) - F.col("n") + F.col(have)
            needed = months.withColumn("_met", met).filter(F.col("_met") < REACH_ROWS).agg(F.min(MONTH), F.max(MONTH)).first()
            if needed[0] is not None:
                a, b = out[k]
                out[k] = (min(a, needed[0]), max(b, needed[1]))
    return _joined(out)


def _affected(rows: DataFrame) -> DataFrame:
    """The rows whose windows reach a changed day, with their rollups."""
    by_date = Window.partitionBy("_series").orderBy("event_date")
    last = F.max(F.when(F.col("_changed"), F.col("event_date"))).over(by_date)
    near = F.max(F.coalesce("_changed", F.lit(False))).over(by_date.rowsBetween(-REACH_ROWS, 0))
    rolled = with_trends(rows.withColumn("_hit", (F.date_diff("event_date", last) <= REACH_DAYS) | near), "daily_units", "_series")
    return rolled.filter("_hit").drop("_hit", "_series", "_span", "_changed", "_before", "_after")


def refresh_months(spark: SparkSession, silver: str, view: str, days: DataFrame) -> Refresh:
    """Bring the view up to date with ``silver`` on the changed ``days`` (rows of ``_days``). Running it again changes nothing."""
    daily_path, gold = f"{view}/daily", f"{view}/gold"
    months = sorted(r[0] for r in days.select(MONTH).distinct().collect())  # at most one value per calendar month
    if not months:
        return Refresh([], [], [])
    fresh = daily_totals(read_months(spark, silver, MONTH, months)).withColumn(MONTH, F.trunc("event_date", "MM"))
    replace_partitions(fresh, daily_path, [MONTH])

    daily = spark.read.schema(fresh.schema).parquet(daily_path)
    available = [date.fromisoformat(v) for v in folder_values(spark, daily_path, MONTH)]
    spans = spans_around(months)
    rows = _in_spans(daily, days, spans)
    wider = _widened(daily, rows, spans, available)
    if wider != spans:
        spans, rows = wider, _in_spans(daily, days, wider)
    with staged(_affected(rows), "affected") as affected:
        written = sorted(r[0] for r in affected.select(MONTH).distinct().collect())
        kept = affected
        held = read_months(spark, gold, MONTH, written)
        if held is not None:
            kept = affected.unionAll(held.select(*affected.columns).join(affected, list(DAILY_KEY), "left_anti"))
        with staged(kept, "gold") as complete:
            replace_partitions(complete, gold, [MONTH])
    return Refresh(months, spans, written)


def merge_and_refresh(spark: SparkSession, silver: str, view: str, events: DataFrame, batch_name: str, unique: bool = False) -> Refresh:
    """Upsert a batch into silver and refresh the view on the days it changed, and on those an interrupted run left behind.

    ``unique``: the events are stored rows, one per natural key.
    """
    pending = f"{view}/pending"
    merge_into(spark, silver, events, on_change=lambda rows: append_batch(_days(rows), pending, batch_name), unique=unique)
    if not table_exists(spark, pending):
        return Refresh([], [], [])
    with staged(_days(spark.read.parquet(pending)), "days") as days:
        done = refresh_months(spark, silver, view, days)
    remove_folder(spark, pending)
    return done
