"""The stages of the demand pipeline, from raw events to forecasts and report tables.

Each stage takes DataFrames and returns DataFrames; ``build_lake`` and ``build_forecasts`` also
write tables.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean, rejects, type_events
from ..operators.dedupe import dedupe_latest
from ..operators.evaluation import forecast_vs_actual, model_comparison, score
from ..operators.marts import daily_category_from_events, dim_category, fact_daily_sales, forecast_mart
from ..operators.naive import seasonal_naive
from ..operators.quality import assert_constraints, fill_calendar, require_rows
from ..operators.rollups import SERIES, daily_totals, rollups
from ..operators.tree import direct_tree
from ..operators.trend import best_param, forecast_forward, rolling_cv, trend_season
from ..operators.upsert import merge_into, stamp, stamps
from ..operators.zones import stored_batches, stored_rows, unknown_rows, zone_map
from ..schemas import AVERAGE, EVENT_KEY, EVENTS
from ..session import materialize
from ..sources.lake import append_batch, current_location, rebuild_partitioned, record_batch, replace_model_partition, table_exists

SILVER_COLUMNS = tuple(EVENTS.names)


def silver_events(raw: DataFrame) -> DataFrame:
    """Typed, cleaned (silver rules) events, the latest row of each natural key."""
    return dedupe_latest(clean(type_events(raw), "silver"))


def staging_events(raw: DataFrame) -> DataFrame:
    """Typed, cleaned (staging rules) events, the latest row of each natural key."""
    return dedupe_latest(clean(type_events(raw), "staging"))


def rollup_job(raw: DataFrame) -> DataFrame:
    """Daily rollups straight from raw events; only the summed columns pass the deduplication."""
    events = clean(type_events(raw), "staging")
    return rollups(dedupe_latest(events, columns=[*EVENT_KEY, "units_sold", "revenue"]))


def daily_series(events: DataFrame) -> DataFrame:
    """Gap-free daily series (``ds``, ``product_category``, ``y``, ``revenue``) of deduplicated events."""
    daily = daily_totals(events).select(F.col("event_date").alias("ds"), "product_category",
                                        F.col("daily_units").alias("y"), F.col("daily_revenue").alias("revenue"))
    return fill_calendar(daily, {"y": 0, "revenue": 0})


class LakeRun(NamedTuple):
    appended: int
    silver: dict[str, int]
    gold: str


def build_lake(spark: SparkSession, raw: DataFrame, root: str, batch_id: str) -> LakeRun:
    """One incremental run of the lake: append new raw rows to bronze, upsert them into silver,
    rebuild gold into a new snapshot, and record all three in the audit. A zone map tells which
    bronze batches have to be opened to find the new rows.

    Silver reads the bronze batches whose MERGE the audit does not record as finished: the new
    batch and whatever an interrupted run left behind, under any batch id. Rows that silver refuses
    are stored with their reason. Gold is rebuilt when silver changed or has not been built since.
    """
    bronze, zones, silver, gold, audit = (f"{root}/{t}" for t in ("bronze", "zones", "silver", "gold", "audit"))
    fresh, _ = unknown_rows(raw, bronze, zones, skip=batch_id)
    append_batch(stamp(fresh.select(*raw.columns), batch_id), bronze, batch_id)
    written = spark.read.schema(raw.schema).parquet(f"{bronze}/_batch_id={batch_id}")
    append_batch(zone_map(written), zones, batch_id)
    appended = spark.read.parquet(f"{zones}/_batch_id={batch_id}").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    if not appended:
        require_rows(spark.read.parquet(bronze), "the event history")
    else:
        record_batch(spark, audit, "bronze", batch_id, "APPEND", bronze, appended, appended)

    metrics = dict.fromkeys(("source_rows", "inserted", "updated", "unchanged"), 0)
    unmerged = unmerged_batches(spark, zones, audit)
    pending = sorted({*unmerged, *([batch_id] if appended else [])})
    if pending:
        history = stored_rows(spark, bronze, raw.schema)
        typed = type_events(history.filter(F.col("_batch_id").isin(pending)).select(*raw.columns))
        refused = rejects(typed, "silver")
        if not refused.isEmpty():
            append_batch(refused, f"{root}/rejects", batch_id)
        good = assert_constraints(clean(typed, "silver").select(*SILVER_COLUMNS), EVENTS)
        metrics = merge_into(spark, silver, good, stamps=stamps(batch_id, layer="silver"))
        for name in pending[:-1]:  # merged together with the last one, which carries the counts
            record_batch(spark, audit, "silver", name, "MERGE", silver)
        record_batch(spark, audit, "silver", pending[-1], "MERGE", silver, **metrics)

    target = current_location(spark, audit, "gold")
    if target is None or unmerged or metrics["inserted"] or metrics["updated"] or _gold_is_old(spark, audit):
        rolled = rollups(spark.read.parquet(silver)).withColumn("event_year", F.year("event_date"))
        target = rebuild_partitioned(rolled, gold, ["product_category"], batch_id)
        record_batch(spark, audit, "gold", batch_id, "OVERWRITE", target)
    return LakeRun(appended, metrics, target)


def unmerged_batches(spark: SparkSession, zones: str, audit: str) -> list[str]:
    """Bronze batches without a finished MERGE in the audit, by the zone map."""
    names = stored_batches(spark, zones)
    if table_exists(spark, audit):
        done = spark.read.parquet(audit).filter("table = 'silver' and operation = 'MERGE'").select("batch_id").distinct()
        names -= {r[0] for r in done.collect()}
    return sorted(names)


def _gold_is_old(spark: SparkSession, audit: str) -> bool:
    """Whether silver has changed since gold was last built."""
    changed = (F.col("table") == "silver") & (F.col("inserted") + F.col("updated") > 0)
    built, merged = spark.read.parquet(audit).agg(F.max(F.when(F.col("table") == "gold", F.col("recorded_at"))),
                                                  F.max(F.when(changed, F.col("recorded_at")))).first()
    return merged is not None and (built is None or built < merged)


def stored_forecast(forecast: DataFrame, model: str) -> DataFrame:
    """A forward forecast as the forecast table stores it: one row per series, date and model, values to four decimals."""
    values = [F.col(c).cast(AVERAGE).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper") if c in forecast.columns]
    return forecast.dropDuplicates([SERIES, "ds"]).select(SERIES, F.col("ds").alias("forecast_date"), *values, "horizon_days",
                                                          F.current_timestamp().alias("generated_at"), F.lit(model).alias("model_name"))


class Forecasts(NamedTuple):
    metrics: DataFrame
    tuning: DataFrame
    forecast: DataFrame
    long: DataFrame


def build_forecasts(series: DataFrame, forecast_path: str | None = None) -> Forecasts:
    """Tune, score three models on the same holdout, forecast forward with the tuned model.

    ``series`` is gap-free. Every intermediate frame has at most one row per series and day.
    """
    series = materialize(series.select("ds", "product_category", "y"), "series")
    tuning = materialize(best_param(rolling_cv(series)), "tuning")
    backtest = materialize(trend_season(series, chosen=tuning), "backtest")
    forecast = materialize(forecast_forward(series, chosen=tuning), "forecast")
    metrics = materialize(model_comparison(score(backtest, "trend_season"),
                                           score(direct_tree(series), "direct_tree"),
                                           score(seasonal_naive(series), "seasonal_naive")), "metrics")
    if forecast_path:
        replace_model_partition(stored_forecast(forecast, "trend_season"), forecast_path)
    return Forecasts(metrics, tuning, forecast, forecast_vs_actual(series, backtest, forecast))
