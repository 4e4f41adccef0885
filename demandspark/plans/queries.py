"""One runnable query per operator, over the sales events of a folder of test tables.

Every query takes ``(spark, folder)``. Forecast figures that sum doubles in no fixed order are
rounded to six decimals here, so that equal results compare equal.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (clean, dashboard, dedupe, evaluation, facts, features, marts, naive, parity, quality,
                         rollups, tree, trend, upsert, zones)
from ..schemas import (CV_INITIAL_DAYS, CV_PERIOD_DAYS, DAILY_KEY, EVENT_KEY, EVENTS, HOLDOUT_DAYS, LEVEL_WINDOW,
                       MIN_LAG, SEASON_LAG)
from ..session import materialize, scratch_path, setting
from ..sources import files, lake, messages
from ..sources.sample import CATEGORIES, REGIONS, messy_events, sales_events
from ..streaming import ingest
from . import stages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Plain baselines for comparison tables: the last year's value without and with growth, and the
# level known at forecast time. They need no fitted model.
BASELINES = ("seasonal_naive", "lag_364", "level")
BASELINE_LABELS = {"seasonal_naive": "Seasonal Naive", "lag_364": "Lag 364", "level": "Level"}
BASELINE_ORDER = {"level": 0, "lag_364": 1, "seasonal_naive": 2}



def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _round(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _latest(spark, d) -> DataFrame:
    return dedupe.dedupe_latest(sales_events(spark, d))


def _latest_totals(spark, d) -> DataFrame:
    """Deduplicated events with only the columns daily totals need."""
    return dedupe.dedupe_latest(sales_events(spark, d), columns=[*EVENT_KEY, "units_sold", "revenue"])


def _stored_events(spark, d) -> DataFrame:
    """The events joined and written once, for queries that read them in several runs."""
    return materialize(sales_events(spark, d), "events")


def _batches(spark, d) -> DataFrame:
    """Events with their batch: the year they arrived."""
    return sales_events(spark, d).withColumn("batch_seq", F.year("ingested_at"))


def _series(spark, d) -> DataFrame:
    return stages.daily_series(_latest_totals(spark, d))


def _stored_series(spark, d) -> DataFrame:
    """The daily series written once, for queries that use it in several branches."""
    return materialize(_series(spark, d), "series")


def _daily(spark, d) -> DataFrame:
    return rollups.daily_totals(_latest_totals(spark, d))


def _rollups(spark, d) -> DataFrame:
    return rollups.rollups(_latest_totals(spark, d))


def _mart(spark, d) -> DataFrame:
    daily = materialize(marts.daily_category_from_events(_latest(spark, d)), "daily")
    return marts.forecast_mart(marts.fact_daily_sales(daily, marts.dim_category(daily)))


def _baseline_predictions(series: DataFrame) -> DataFrame:
    """Holdout predictions of the baselines, long: ds, series, y, model, yhat."""
    holdout = features.lagged_level(features.shift_days(features.time_split(series))).filter("is_holdout")
    plain = holdout.select("ds", "product_category", "y", F.col(f"y_{SEASON_LAG}d_ago").cast("double").alias("lag_364"),
                           "level")
    long = plain.unpivot(["ds", "product_category", "y"], ["lag_364", "level"], "model", "yhat")
    return long.unionByName(naive.seasonal_naive(series).withColumn("model", F.lit("seasonal_naive")))


def _metrics(series: DataFrame) -> DataFrame:
    return evaluation.score(_baseline_predictions(series), F.col("model"))


def _stored_metrics(spark, d) -> DataFrame:
    return materialize(_metrics(_stored_series(spark, d)), "metrics")


def _forecast_table(series: DataFrame) -> DataFrame:
    """Forward forecast as the forecast table stores it (four decimals)."""
    return naive.seasonal_naive_forward(series).withColumn("yhat", F.col("yhat").cast("decimal(18,4)"))


# ---- sources -------------------------------------------------------------------------------

@query
def scan_mart(spark, d):
    path = scratch_path(spark, "mart")
    _mart(spark, d).write.parquet(path)
    return files.read_mart(spark, path, ["ds", "product_category", "y"])


@query
def replay_slice(spark, d):
    sent = messages.publish_slice(sales_events(spark, d), [*EVENT_KEY, "ingested_at", "id"], offset=1000)
    return messages.parse_events(sent).drop("_corrupt_record")


@query
def replay_resume(spark, d):
    """Four publishing runs over a stored order; the second stops before its offset is committed and is repeated. All messages."""
    history, offsets, topic = (scratch_path(spark, n) for n in ("positions", "offsets", "topic"))
    messages.index_positions(sales_events(spark, d), [*EVENT_KEY, "ingested_at", "id"], history)
    _, sent = messages.publish_next(spark, history, offsets, topic, 1000)
    messages.send_slice(spark, history, topic, sent, sent + 1500, version=2)  # stopped here
    messages.publish_next(spark, history, offsets, topic, 1200)
    messages.publish_next(spark, history, offsets, topic)
    return messages.parse_events(spark.read.schema(_STREAM_SCHEMA).parquet(topic)).select(*EVENTS.names)


def _broken_messages(spark, d) -> DataFrame:
    """Messages of which some are cut off, some have text for a number and some lack a required field."""
    sent = messages.to_messages(sales_events(spark, d))
    units = F.get_json_object("value", "$.units_sold").cast("int")
    broken = F.when(units < 3, F.expr("substring(value, 1, length(value) - 1)")) \
        .when(units == 50, F.regexp_replace("value", '"units_sold":50', '"units_sold":"x"')) \
        .when(units == 49, F.regexp_replace("value", '"units_sold":49', '"units_sold":null')) \
        .when(units == 48, F.regexp_replace("value", '"store_region":"[^"]*",?', "")).otherwise(F.col("value"))
    return sent.withColumn("value", broken)


@query
def parse_events(spark, d):
    return messages.parse_events(_broken_messages(spark, d)).drop("_corrupt_record")


# ---- cleaning and duplicates -----------------------------------------------------------------

@query
def type_events(spark, d):
    return clean.type_events(messy_events(spark, d))


@query
def clean_staging(spark, d):
    return clean.clean(clean.type_events(messy_events(spark, d)), "staging")


@query
def clean_silver(spark, d):
    return clean.clean(clean.type_events(messy_events(spark, d)), "silver")


@query
def rejects(spark, d):
    bad = clean.rejects(clean.type_events(messy_events(spark, d)), "silver")
    return bad.select("id", *EVENT_KEY, F.concat_ws("|", "reasons").alias("reasons"))


@query
def dedupe_latest(spark, d):
    return _latest(spark, d)


@query
def dedupe_first(spark, d):
    ev = _batches(spark, d)
    return dedupe.dedupe_first(ev.filter("batch_seq >= 1998").drop("batch_seq"), ev.filter("batch_seq < 1998"))


@query
def duplicate_stats(spark, d):
    return dedupe.duplicate_stats(sales_events(spark, d))


@query
def duplicate_groups(spark, d):
    return dedupe.duplicate_groups(sales_events(spark, d))


@query
def stg_rollups(spark, d):
    padded = F.concat(F.lit(" "), "product_category", F.lit(" "))
    return clean.stg_rollups(_rollups(spark, d).withColumns({"product_category": padded,
                                                             "event_date": F.col("event_date").cast("string")}))


# ---- lake maintenance ------------------------------------------------------------------------

@query
def bronze_new_rows(spark, d):
    """Events that a bronze table of two batches lacks; its zone map leaves known and new months unopened."""
    bronze, zone_path, ev = scratch_path(spark, "bronze"), scratch_path(spark, "zones"), sales_events(spark, d)
    arrived = F.year("ingested_at")
    for name, rows in (("a", ev.filter(arrived <= 1996)), ("b", ev.filter((arrived > 1996) & (F.col("ingested_at") < "1998-06-15")))):
        lake.append_batch(rows, bronze, name)
    return zones.unknown_rows(ev, bronze, zone_path)[0]


@query
def upsert_newer(spark, d):
    ev = _batches(spark, d)
    target = upsert.as_of(ev, 1998)
    return upsert.upsert_newer(target, ev.filter("batch_seq >= 1997").drop("batch_seq"))


@query
def upsert_metrics(spark, d):
    ev = _batches(spark, d)
    return upsert.upsert_metrics(upsert.as_of(ev, 1998), ev.filter("batch_seq >= 1997"))


@query
def constraint_violations(spark, d):
    return quality.constraint_violations(clean.type_events(messy_events(spark, d)), quality.SILVER_NOT_NULL,
                                         quality.SILVER_RULES)


@query
def snapshot_diff(spark, d):
    ev = _batches(spark, d)
    return upsert.snapshot_diff(upsert.as_of(ev, 1998), upsert.as_of(ev, 1999), ["id", *EVENT_KEY, "units_sold"])


@query
def silver_as_of(spark, d):
    return upsert.as_of(_batches(spark, d), 1998)


@query
def batch_history(spark, d):
    per_batch = _batches(spark, d).groupBy("batch_seq").agg(F.count("*").alias("source_rows"))
    version = (F.col("batch_seq") - 1995).cast("bigint").alias("version")
    operations = {"bronze": "APPEND", "silver": "MERGE"}
    audit = evaluation.union_metrics(*[
        per_batch.select(F.lit(t).alias("table"), version, F.lit(op).alias("operation"), "source_rows")
        for t, op in operations.items()])
    return lake.batch_history(audit, last=5)


@query
def lake_build(spark, d):
    """Two incremental runs of the lake (years to 1998, then everything); the rebuilt gold table."""
    root = scratch_path(spark, "lake")
    raw = _stored_events(spark, d)
    stages.build_lake(spark, raw.filter(F.year("ingested_at") <= 1998), root, "run1")
    run = stages.build_lake(spark, raw, root, "run2")
    return spark.read.parquet(run.gold).drop("event_year")


@query
def lake_recovery(spark, d):
    """A run that stopped after bronze, completed by the next run under a new batch id; the gold table."""
    root = scratch_path(spark, "lake")
    raw = _stored_events(spark, d)
    lake.append_batch(upsert.stamp(raw.filter(F.year("ingested_at") <= 1998), "stopped"), f"{root}/bronze", "stopped")
    run = stages.build_lake(spark, raw, root, "next")
    return spark.read.parquet(run.gold).drop("event_year")


@query
def silver_audit(spark, d):
    """Which of two lake runs wrote each silver row last."""
    root, raw = scratch_path(spark, "lake"), _stored_events(spark, d)
    stages.build_lake(spark, raw.filter(F.year("ingested_at") <= 1998), root, "run1")
    stages.build_lake(spark, raw, root, "run2")
    return spark.read.parquet(f"{root}/silver").select("id", *EVENT_KEY, "_silver_batch_id")


@query
def table_detail(spark, d):
    """Rows per partition of the stored rollups."""
    path = scratch_path(spark, "rollups")
    lake.replace_partitions(_rollups(spark, d), path, ["product_category"])
    return lake.table_detail(spark, path).select("partition", "rows")


@query
def table_fingerprint(spark, d):
    """Fingerprint of the events stored in two batches; files and order do not matter."""
    path, ev = scratch_path(spark, "batches"), sales_events(spark, d)
    for name, rows in (("a", ev.filter("units_sold < 20")), ("b", ev.filter("units_sold >= 20"))):
        lake.append_batch(rows, path, name)
    return lake.fingerprint(spark.read.parquet(path).drop("_batch_id"))


@query
def replace_model(spark, d):
    """Stored predictions of three models after one of them was replaced."""
    path, predictions = scratch_path(spark, "forecast"), _baseline_predictions(_stored_series(spark, d))
    stored = predictions.select("ds", "product_category", "yhat", F.col("model").alias("model_name"))
    lake.replace_model_partition(stored, path)
    lake.replace_model_partition(stored.filter("model_name = 'level'").withColumn("yhat", F.lit(0.0)), path)
    return spark.read.parquet(path).select(*stored.columns)


@query
def silver_rejects(spark, d):
    """Rows that a lake run refused for silver, as it stored them."""
    root = scratch_path(spark, "lake")
    stages.build_lake(spark, messy_events(spark, d), root, "run1")
    return spark.read.parquet(f"{root}/rejects").select("id", *EVENT_KEY, F.concat_ws("|", "reasons").alias("reasons"))


@query
def compact_events(spark, d):
    """Events stored in two batches, rewritten in order of their key."""
    source, target = scratch_path(spark, "batches"), scratch_path(spark, "compact")
    ev = sales_events(spark, d)
    for name, rows in (("a", ev.filter("units_sold < 20")), ("b", ev.filter("units_sold >= 20"))):
        lake.append_batch(rows, source, name)
    lake.compact(spark, source, target, EVENT_KEY)
    return spark.read.parquet(target).select(*ev.columns)


@query
def history_csv(spark, d):
    """Events exported as CSV in order of their key and read back as sales history."""
    path = scratch_path(spark, "history")
    ev = sales_events(spark, d)
    columns = {"date": "event_date", **{c: c for c in files.HISTORY_CSV.names[1:]}}
    files.write_csv(ev.select(*[F.col(c).cast(files.HISTORY_CSV[n].dataType).alias(n) for n, c in columns.items()]), path, ["date", "product_category"])
    return files.read_history_csv(spark, path)


@query
def inferred_csv(spark, d):
    """Daily totals exported as CSV and read back with types found from the text; two columns fit a pattern but not its type."""
    path = scratch_path(spark, "daily-csv")
    daily = _daily(spark, d)
    too_long = F.concat(F.col("daily_units").cast("string"), F.lit("0" * 20))
    no_date = F.when(F.dayofmonth("event_date") == 1, "2024-99-99").otherwise(F.col("event_date").cast("string"))
    files.write_csv(daily.select("event_date", "product_category", "daily_units", too_long.alias("big"), no_date.alias("odd_date")), path)
    return files.read_csv_inferred(spark, path)


# ---- aggregates and windows ------------------------------------------------------------------

@query
def daily_totals(spark, d):
    return _daily(spark, d)


@query
def daily_mix(spark, d):
    return rollups.daily_mix(_latest(spark, d))


@query
def monthly_category(spark, d):
    return marts.monthly_category(_mart(spark, d))


@query
def monthly_total(spark, d):
    return marts.monthly_total(marts.monthly_category(_series(spark, d)))


@query
def category_totals(spark, d):
    return marts.category_totals(sales_events(spark, d))


@query
def month_by_category(spark, d):
    return marts.month_by_category(sales_events(spark, d), list(CATEGORIES))


@query
def series_span(spark, d):
    return marts.series_span(_daily(spark, d).withColumnRenamed("event_date", "ds"))


@query
def distinct_categories(spark, d):
    return sales_events(spark, d).select("product_category").distinct()


@query
def rolling_7d(spark, d):
    return rollups.rolling_mean(_daily(spark, d), 7)


@query
def rolling_30d(spark, d):
    return rollups.rolling_mean(_daily(spark, d), 30)


@query
def wow_rows(spark, d):
    return rollups.wow_rows(_daily(spark, d))


@query
def wow_days(spark, d):
    return rollups.wow_days(_daily(spark, d))


def _rollup_query(spark, d):
    return _rollups(spark, d)


QUERIES["rollups"] = _rollup_query


# ---- star schema -----------------------------------------------------------------------------

@query
def daily_category(spark, d):
    latest = _latest(spark, d)
    return marts.daily_category(rollups.daily_mix(latest), rollups.rollups(latest))


@query
def dim_category(spark, d):
    return marts.dim_category(sales_events(spark, d))


@query
def fact_daily_sales(spark, d):
    daily = materialize(marts.daily_category_from_events(_latest(spark, d)), "daily")
    return marts.fact_daily_sales(daily, marts.dim_category(daily))


@query
def forecast_mart(spark, d):
    return _mart(spark, d)


# ---- quality and parity ----------------------------------------------------------------------

@query
def dq_suite(spark, d):
    return quality.run_suite(clean.type_events(messy_events(spark, d)), quality.sales_checks(CATEGORIES, REGIONS))


@query
def dq_unique_key(spark, d):
    return quality.run_suite(_latest(spark, d), [quality.unique_key(*EVENT_KEY), quality.unique_key(*DAILY_KEY),
                                                 quality.unique_key("id")])


@query
def non_empty(spark, d):
    ev = sales_events(spark, d)
    return quality.non_empty(ev, "events").unionAll(quality.non_empty(ev.filter("units_sold < 0"), "negative events"))


@query
def gap_check(spark, d):
    return quality.gap_check(_daily(spark, d).withColumnRenamed("event_date", "ds"))


@query
def fill_calendar(spark, d):
    return _series(spark, d)


@query
def missing_days(spark, d):
    return quality.missing_days(_daily(spark, d).withColumnRenamed("event_date", "ds"))


@query
def missing_from(spark, d):
    ev = _batches(spark, d)
    return quality.missing_from(ev.filter("batch_seq <= 1998"), ev.filter("batch_seq > 1998"), EVENT_KEY) \
        .select("id", *EVENT_KEY)


@query
def profile(spark, d):
    return parity.profile(_rollups(spark, d))


@query
def reconcile(spark, d):
    return parity.reconcile(_rollups(spark, d), rollups.rollups(upsert.as_of(_batches(spark, d), 2000)))


@query
def parity_summary(spark, d):
    return parity.parity_summary(*parity.rollups_by_rule(clean.type_events(messy_events(spark, d))))


@query
def parity_rows(spark, d):
    return parity.parity_rows(*parity.rollups_by_rule(clean.type_events(messy_events(spark, d))))


@query
def key_counts(spark, d):
    ev = _batches(spark, d)
    return parity.key_counts(ev, ev.filter("batch_seq <= 2000"), upsert.as_of(ev, 2000))


@query
def parity_layers(spark, d):
    ev = sales_events(spark, d)
    return parity.parity_layers(ev, _batches(spark, d).filter("batch_seq <= 2000").select(*ev.columns), dedupe.dedupe_latest(ev))


# ---- forecasting -----------------------------------------------------------------------------

@query
def time_split(spark, d):
    return features.time_split(_series(spark, d))


@query
def calendar_features(spark, d):
    return features.calendar_features(_series(spark, d).select("ds", "product_category"))


@query
def with_holidays(spark, d):
    return features.with_holidays(_series(spark, d).select("ds", "product_category"))


@query
def lagged_level(spark, d):
    return features.lagged_level(_series(spark, d), MIN_LAG, LEVEL_WINDOW).drop("revenue")


@query
def lag_features(spark, d):
    return features.lag_features(_series(spark, d)).drop("revenue")


@query
def eligible(spark, d):
    return features.eligible(features.make_features(_series(spark, d)))


@query
def shift_364(spark, d):
    return features.shift_days(_series(spark, d), SEASON_LAG).drop("revenue")


@query
def trailing_growth(spark, d):
    return naive.trailing_growth(_series(spark, d))


@query
def seasonal_naive(spark, d):
    return naive.seasonal_naive(_series(spark, d))


@query
def seasonal_naive_forward(spark, d):
    return naive.seasonal_naive_forward(_series(spark, d))


@query
def rolling_origins(spark, d):
    return features.rolling_origins(_series(spark, d), CV_INITIAL_DAYS, CV_PERIOD_DAYS, HOLDOUT_DAYS)


@query
def future_frame(spark, d):
    return features.future_frame(_daily(spark, d).withColumnRenamed("event_date", "ds"))


@query
def horizon_bucket(spark, d):
    ahead = features.future_frame(_daily(spark, d).withColumnRenamed("event_date", "ds"))
    return ahead.withColumn("horizon_days", naive.horizon_bucket(F.date_diff("ds", "last_ds")))


@query
def score_frame(spark, d):
    series = _stored_series(spark, d)
    return evaluation.score_frame(series, naive.seasonal_naive(series))


@query
def score(spark, d):
    return _round(evaluation.score(naive.seasonal_naive(_series(spark, d)), "seasonal_naive"), ["mape", "rmse"])


@query
def interval(spark, d):
    return _round(evaluation.interval(naive.seasonal_naive(_series(spark, d))), ["residual_low", "residual_high"])


@query
def forecast_vs_actual(spark, d):
    series = _stored_series(spark, d)
    backtest = naive.seasonal_naive(series)
    bounds = evaluation.interval(backtest)
    long = evaluation.forecast_vs_actual(
        series, evaluation.with_interval(backtest, bounds),
        evaluation.with_interval(naive.seasonal_naive_forward(series), bounds))
    return _round(long, ["units", "units_lower", "units_upper"])


@query
def model_comparison(spark, d):
    series = _stored_series(spark, d)
    predictions = _baseline_predictions(series)
    parts = [evaluation.score(predictions.filter(F.col("model") == m), m) for m in BASELINES]
    return _round(evaluation.model_comparison(*parts, order=BASELINE_ORDER), ["mape", "rmse"])


@query
def model_means(spark, d):
    return _round(evaluation.model_means(_metrics(_stored_series(spark, d))), ["mean_mape", "mean_rmse"])


@query
def winner(spark, d):
    return _round(evaluation.winner(_metrics(_stored_series(spark, d))), ["mean_mape"])


@query
def mape_wide(spark, d):
    return _round(dashboard.mape_wide(_metrics(_stored_series(spark, d)), BASELINES), BASELINES)


@query
def flatten_metrics(spark, d):
    return _round(evaluation.flatten_metrics(_metrics(_stored_series(spark, d))), ["value"])


@query
def trend_season(spark, d):
    return trend.trend_season(_stored_series(spark, d))


@query
def rolling_cv(spark, d):
    return trend.rolling_cv(_stored_series(spark, d))


@query
def best_param(spark, d):
    """The tuning table of a cross-validation table that needs no fit: errors of the baselines stand for three grid values."""
    value = F.when(F.col("model") == "level", 0.001).when(F.col("model") == "lag_364", 0.01).otherwise(0.1)
    cv = _metrics(_stored_series(spark, d)).select("product_category", value.alias("flexibility"), F.col("mape").alias("cv_mape"))
    return trend.best_param(materialize(cv, "cv"))


@query
def tuned_param(spark, d):
    return trend.best_param(materialize(trend.rolling_cv(_stored_series(spark, d)), "cv"))


@query
def forecast_forward(spark, d):
    return trend.forecast_forward(_stored_series(spark, d))


@query
def direct_tree(spark, d):
    return tree.direct_tree(_series(spark, d))


def _contract(predictions: DataFrame, *more) -> DataFrame:
    """What any model has to keep: days predicted per series, and values that are missing or negative."""
    return predictions.groupBy("product_category").agg(
        F.count("*").alias("n_rows"), F.count_distinct("ds").alias("n_days"), F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"),
        F.count_if(F.coalesce(F.col("yhat") < 0, F.lit(True))).alias("missing_or_negative"), *more)


def _crossed():
    return F.count_if(F.coalesce(F.col("yhat_lower") > F.col("yhat_upper"), F.lit(True)) | (F.col("yhat_lower") < 0)).alias("crossed")


@query
def trend_season_contract(spark, d):
    """The holdout of the trend model; ``saw_holdout`` counts predictions that change when the holdout's actuals do."""
    series = _stored_series(spark, d)
    hidden = features.time_split(series).withColumn("y", F.when(F.col("is_holdout"), F.lit(0).cast("bigint")).otherwise(F.col("y")))
    blind = trend.trend_season(hidden.select(*series.columns)).select("ds", "product_category", F.col("yhat").alias("blind"))
    both = trend.trend_season(series).join(blind, ["ds", "product_category"], "left")
    saw = F.count_if(F.coalesce(F.abs(F.col("yhat") - F.col("blind")) > 1e-9 * F.abs("yhat"), F.lit(True))).alias("saw_holdout")
    return _contract(both, _crossed(), saw)


@query
def forecast_forward_contract(spark, d):
    return _contract(trend.forecast_forward(_stored_series(spark, d)), _crossed(), F.count_if(F.col("horizon_days") == 30).alias("first_month"))


@query
def direct_tree_contract(spark, d):
    return _contract(tree.direct_tree(_series(spark, d)))


@query
def trained_model_comparison(spark, d):
    series = _stored_series(spark, d)
    return evaluation.model_comparison(evaluation.score(trend.trend_season(series), "trend_season"),
                                       evaluation.score(tree.direct_tree(series), "direct_tree"),
                                       evaluation.score(naive.seasonal_naive(series), "seasonal_naive"))


# ---- report facts ----------------------------------------------------------------------------

@query
def period_means(spark, d):
    series = _stored_series(spark, d)
    return _round(facts.period_means(series, facts.recent_period(series)), ["mean_now", "mean_1y_ago", "mean_2y_ago"])


@query
def yoy_trend(spark, d):
    return _round(facts.yoy_trend(_stored_series(spark, d)), ["recent_avg", "year_earlier_avg", "yoy_pct"])


@query
def yoy_ranking(spark, d):
    return _round(facts.yoy_ranking(facts.yoy_trend(_stored_series(spark, d))), ["yoy_pct"])


@query
def forecast_yoy(spark, d):
    series = _stored_series(spark, d)
    result = facts.forecast_yoy(naive.seasonal_naive_forward(series), series)
    return _round(result, ["forecast_avg", "same_dates_last_year_avg", "forecast_yoy_pct", "prior_year_yoy_pct"])


@query
def horizon_summary(spark, d):
    return _round(facts.horizon_summary(naive.seasonal_naive_forward(_series(spark, d))),
                  ["days_1_30", "days_31_60", "days_61_90"])


@query
def best_model(spark, d):
    return facts.best_model(_metrics(_stored_series(spark, d)), BASELINE_ORDER)


@query
def win_counts(spark, d):
    return facts.win_counts(_stored_metrics(spark, d), BASELINE_ORDER)


@query
def won_series(spark, d):
    return facts.won_series(_metrics(_stored_series(spark, d)), BASELINE_ORDER)


@query
def beats(spark, d):
    return facts.beats(_metrics(_stored_series(spark, d)), "seasonal_naive", "lag_364")


@query
def recommendation(spark, d):
    return _round(facts.recommendation(_metrics(_stored_series(spark, d)), "seasonal_naive"), ["gap_pp"])


@query
def fact_lines(spark, d):
    series = _stored_series(spark, d)
    forecast = naive.seasonal_naive_forward(series)
    return facts.fact_lines(series, forecast, materialize(_metrics(series), "metrics"), "seasonal_naive", BASELINE_LABELS, BASELINE_ORDER,
                            rivals=("seasonal_naive", "lag_364"))


# ---- dashboard tables ------------------------------------------------------------------------

@query
def label_models(spark, d):
    return dashboard.label(_round(_metrics(_stored_series(spark, d)), ["mape", "rmse"]), "model", BASELINE_LABELS)


@query
def display_comparison(spark, d):
    return dashboard.display_comparison(_metrics(_stored_series(spark, d)), BASELINE_LABELS)


@query
def heatmap(spark, d):
    return dashboard.heatmap(dashboard.display_comparison(_metrics(_stored_series(spark, d)), BASELINE_LABELS))


@query
def next_90(spark, d):
    return dashboard.next_90(_forecast_table(_series(spark, d)))


@query
def next_90_sorted(spark, d):
    return dashboard.next_90_sorted(dashboard.next_90(_forecast_table(_series(spark, d))))


@query
def next_90_growth(spark, d):
    series = _stored_series(spark, d)
    return dashboard.next_90_growth(dashboard.next_90(_forecast_table(series)), marts.monthly_category(series))


@query
def monthly_revenue_m(spark, d):
    return dashboard.monthly_revenue_m(marts.monthly_total(marts.monthly_category(_series(spark, d))))


@query
def seasonal_index(spark, d):
    return dashboard.seasonal_index(marts.monthly_category(_series(spark, d)))


@query
def revenue_share(spark, d):
    return dashboard.revenue_share(marts.monthly_category(_stored_series(spark, d)))


@query
def q4_yoy(spark, d):
    return dashboard.q4_yoy(marts.monthly_category(_stored_series(spark, d)))


@query
def kpis(spark, d):
    series = _stored_series(spark, d)
    return dashboard.kpis(marts.monthly_category(series), dashboard.next_90(_forecast_table(series)),
                          _metrics(series), BASELINES)


@query
def backtest_total(spark, d):
    series = _stored_series(spark, d)
    backtest = naive.seasonal_naive(series)
    long = evaluation.forecast_vs_actual(series, backtest, naive.seasonal_naive_forward(series))
    return _round(dashboard.backtest_total(long), ["actual_units", "backtest_units"])


@query
def series_code(spark, d):
    series = _stored_series(spark, d)
    long = evaluation.forecast_vs_actual(series, naive.seasonal_naive(series), naive.seasonal_naive_forward(series))
    return dashboard.series_code(long).drop("units_lower", "units_upper")


# ---- streaming -------------------------------------------------------------------------------

_STREAM_SCHEMA = "key string, value string, ingested_at timestamp_ntz, id bigint"


def _published(spark: SparkSession, d: str, per_file: bool) -> str:
    """The events as message files: a single batch, or one folder entry per arrival year."""
    path = scratch_path(spark, "messages")
    sent = messages.to_messages(sales_events(spark, d))
    if not per_file:
        messages.write_messages(sent, path)
        return path
    # Only a year beyond this size is split into several entries, each still written by one task.
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m"):
        messages.write_messages(sent.withColumn("_year", F.year("ingested_at")).hint("rebalance", "_year").drop("_year"), path)
    return path


@query
def stream_ingest(spark, d):
    """Ingest every message, then replay all of them with a new checkpoint; the stored events."""
    source, table = _published(spark, d, False), scratch_path(spark, "ingested")
    for _ in range(2):
        stream = messages.read_event_stream(spark, source, schema=_STREAM_SCHEMA)
        ingest.run_available(ingest.ingest_stream(stream, table, scratch_path(spark, "checkpoint")))
    return spark.read.parquet(table).select(*EVENTS.names)


@query
def stream_rollups(spark, d):
    """Micro-batches upserted into silver, with the rollups of touched categories kept current."""
    source, silver, gold = _published(spark, d, True), scratch_path(spark, "silver"), scratch_path(spark, "gold")
    stream = messages.read_event_stream(spark, source, max_per_batch=3, schema=_STREAM_SCHEMA)
    ingest.run_available(ingest.rollup_stream(stream, silver, gold, scratch_path(spark, "checkpoint")))
    return spark.read.parquet(f"{gold}/gold").drop("event_month")


@query
def ingest_stats(spark, d):
    """Counts of an ingest run over partly broken messages, and of a replay of all of them."""
    source, table, bad = (scratch_path(spark, n) for n in ("messages", "ingested", "quarantine"))
    messages.write_messages(_broken_messages(spark, d), source)
    runs = []
    for name in ("first", "replay"):
        stream, log = messages.read_event_stream(spark, source, schema=_STREAM_SCHEMA), scratch_path(spark, "log")
        ingest.run_available(ingest.ingest_stream(stream, table, scratch_path(spark, "checkpoint"), bad, log=log))
        runs.append(ingest.ingest_stats(ingest.read_log(spark, log)).withColumn("run", F.lit(name)))
    return runs[0].unionAll(runs[1])


@query
def stream_late(spark, d):
    """Three deliveries to one stream; events more than 30 days behind what came before are kept apart. Stored and late events."""
    source, table, late, log, checkpoint = (scratch_path(spark, n) for n in ("messages", "ingested", "late", "log", "checkpoint"))
    events, year = _stored_events(spark, d), F.year("ingested_at")
    for delivery in (year <= 1996, year.between(1997, 1998), year > 1998):
        messages.write_messages(messages.to_messages(events.filter(delivery)), source)
        stream = messages.read_event_stream(spark, source, schema=_STREAM_SCHEMA)
        ingest.run_available(ingest.ingest_stream(stream, table, checkpoint, log=log, late=late, lateness_days=30))
    stored, behind = (spark.read.parquet(p).select("id", F.lit(n).alias("status")) for p, n in ((table, "stored"), (late, "late")))
    return stored.unionAll(behind)


@query
def stream_capped(spark, d):
    """Two runs that end after 1,500 and 2,000 messages; the stored events."""
    source, table, log, backlog, checkpoint = (scratch_path(spark, n) for n in ("messages", "ingested", "log", "backlog", "checkpoint"))
    messages.write_messages(messages.to_messages(sales_events(spark, d)), source)
    for cap in (1500, 2000):
        stream = messages.read_event_stream(spark, source, schema=_STREAM_SCHEMA)
        ingest.run_available(ingest.ingest_stream(stream, table, checkpoint, log=log, max_messages=cap, backlog=backlog))
    return spark.read.parquet(table).select(*EVENTS.names)
