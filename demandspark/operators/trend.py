"""Trend-and-season model: one small fit per series, tuned by rolling origins.

Spark spreads series (and origins) over the cluster; Python only solves the normal equations of
one series at a time. A series has at most one row per calendar day, so it fits one task. The
model is a Gaussian relative of additive models with Laplace trend priors, not a copy of one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import holiday_code, mape
from ..schemas import CV_INITIAL_DAYS, CV_PERIOD_DAYS, FLEXIBILITY_GRID, HOLDOUT_DAYS
from . import ridge
from .features import future_frame, rolling_origins, time_split, with_cutoff
from .naive import check_horizon, horizon_bucket
from .rollups import SERIES

# Ship the fit with the tasks, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(ridge)

_KEYS = [SERIES, "cutoff"]
_SCHEMA = f"{SERIES} string, cutoff date, ds date, y double, flexibility double, yhat double, " \
          "yhat_lower double, yhat_upper double"


def _prepared(df: DataFrame) -> DataFrame:
    return df.select(SERIES, "cutoff", "ds", F.col("y").cast("double").alias("y"), "is_train",
                     F.unix_date("ds").alias("day"), holiday_code(F.col("ds")).alias("us_holiday"))


def fit_and_predict(df: DataFrame, grid: Sequence[float]) -> DataFrame:
    """Predictions for the rows with ``is_train`` false, per series, cutoff and flexibility."""
    predict, values, keys = ridge.predict, [float(g) for g in grid], _KEYS
    return _prepared(df).groupBy(*keys).applyInPandas(lambda pdf: predict(pdf, values, keys), _SCHEMA)


def _fit_chosen(df: DataFrame, chosen: DataFrame | None, flexibility: float) -> DataFrame:
    """Fit with one flexibility for all series, or with the one ``chosen`` has for each.

    A series that ``chosen`` lacks (too short for one origin, say) is fitted with ``flexibility``.
    """
    if chosen is None:
        return fit_and_predict(df, [flexibility])
    predict, keys = ridge.predict, _KEYS
    picked = _prepared(df).join(chosen.select(SERIES, F.col("flexibility").alias("_tuned")), SERIES, "left") \
        .withColumn("flexibility", F.coalesce("_tuned", F.lit(float(flexibility)))).drop("_tuned")
    return picked.groupBy(*keys).applyInPandas(
        lambda pdf: predict(pdf, [float(pdf["flexibility"].iloc[0])], keys), _SCHEMA)


def trend_season(df: DataFrame, flexibility: float = 0.05, chosen: DataFrame | None = None,
                 horizon: int = HOLDOUT_DAYS) -> DataFrame:
    """Holdout predictions of a model that saw nothing after the cutoff."""
    split = time_split(df, horizon).withColumn("is_train", ~F.col("is_holdout"))
    return _fit_chosen(split, chosen, flexibility).select("ds", SERIES, "y", "yhat", "yhat_lower", "yhat_upper")


def rolling_cv(df: DataFrame, grid: Sequence[float] = FLEXIBILITY_GRID, initial: int = CV_INITIAL_DAYS,
               period: int = CV_PERIOD_DAYS, horizon: int = HOLDOUT_DAYS) -> DataFrame:
    """Error per series and flexibility over rolling origins in the training part."""
    return cv_predictions(df, grid, initial, period, horizon).groupBy(SERIES, "flexibility").agg(
        mape(F.col("y"), F.col("yhat")).alias("cv_mape"), F.count_distinct("cutoff").alias("origins"))


def cv_predictions(df: DataFrame, grid: Sequence[float] = FLEXIBILITY_GRID, initial: int = CV_INITIAL_DAYS,
                   period: int = CV_PERIOD_DAYS, horizon: int = HOLDOUT_DAYS) -> DataFrame:
    """Predictions behind every rolling origin, per series and flexibility.

    A series goes to one task once, whatever the number of origins: the normal equations of all its training spans come from
    running sums over its days (``ridge.Folds``), and a fold costs a solve per grid value.
    """
    split = with_cutoff(df, horizon).filter(F.col("ds") <= F.col("cutoff")).drop("cutoff")
    origins = rolling_origins(split, initial, period, horizon).select(SERIES, "cutoff", F.unix_date("cutoff").alias("last"))
    validate, values, ahead, name = ridge.cross_validate, [float(g) for g in grid], horizon, SERIES
    rows = split.select(SERIES, "ds", F.col("y").cast("double").alias("y"), F.unix_date("ds").alias("day"), holiday_code(F.col("ds")).alias("us_holiday"))
    return rows.groupBy(SERIES).cogroup(origins.groupBy(SERIES)).applyInPandas(
        lambda pdf, own: validate(pdf, own, values, ahead, name), f"{SERIES} string, cutoff date, ds date, y double, flexibility double, yhat double")


def cv_refits(df: DataFrame, grid: Sequence[float] = FLEXIBILITY_GRID, initial: int = CV_INITIAL_DAYS,
              period: int = CV_PERIOD_DAYS, horizon: int = HOLDOUT_DAYS) -> DataFrame:
    """The same predictions by a fit of each (series, origin) from its rows: a check of ``cv_predictions``."""
    split = with_cutoff(df, horizon).filter(F.col("ds") <= F.col("cutoff")).drop("cutoff")
    origins = rolling_origins(split, initial, period, horizon)
    folds = split.join(origins, SERIES).filter(F.col("ds") <= F.date_add("cutoff", horizon)) \
        .withColumn("is_train", F.col("ds") <= F.col("cutoff"))
    return fit_and_predict(folds, grid).select(SERIES, "cutoff", "ds", "y", "flexibility", "yhat")


def best_param(cv: DataFrame, grid: Sequence[float] = FLEXIBILITY_GRID) -> DataFrame:
    """Flexibility with the lowest error per series (the smaller on a tie), and the error of each
    grid value as a column."""
    best = cv.filter(F.col("cv_mape").isNotNull()).groupBy(SERIES).agg(
        F.min_by("flexibility", F.struct("cv_mape", "flexibility")).alias("flexibility"))
    wide = cv.groupBy(SERIES).pivot("flexibility", list(grid)).agg(F.round(F.first("cv_mape"), 3))
    renamed = wide.select(SERIES, *[F.col(f"`{g}`").alias(f"cv_mape_{str(g).replace('.', '_')}") for g in grid])
    return best.join(renamed, SERIES)


def forecast_series_status(df: DataFrame, chosen: DataFrame, flexibility: float = 0.05, horizon: int = HOLDOUT_DAYS) -> DataFrame:
    """One row per series: days of history, whether a backtest is possible, the flexibility used and where it comes from."""
    days = with_cutoff(df, horizon).groupBy(SERIES).agg(
        F.count("*").alias("days"), F.count_if(F.col("ds") <= F.col("cutoff")).alias("train_days"))
    joined = days.join(chosen.select(SERIES, F.col("flexibility").alias("_tuned")), SERIES, "left")
    return joined.select(
        SERIES, "days", (F.col("train_days") > 0).alias("has_backtest"), F.coalesce("_tuned", F.lit(float(flexibility))).alias("flexibility"),
        F.when(F.col("_tuned").isNotNull(), "tuned").when(F.col("train_days") > 0, "default: no complete origin")
        .otherwise("default: no day before the holdout").alias("reason"))


def forecast_forward(df: DataFrame, flexibility: float = 0.05, chosen: DataFrame | None = None,
                     horizon: int = HOLDOUT_DAYS) -> DataFrame:
    """Refit on the whole history and forecast the days after it, at most as many as there are buckets for."""
    check_horizon(horizon)
    history = df.select("ds", SERIES, F.col("y").cast("double").alias("y"))
    future = future_frame(df, horizon).select("ds", SERIES, F.lit(None).cast("double").alias("y"))
    marked = history.withColumn("is_train", F.lit(True)).unionByName(future.withColumn("is_train", F.lit(False)))
    split = with_cutoff(marked, horizon)
    return _fit_chosen(split, chosen, flexibility).select(
        "ds", SERIES, F.col("cutoff").alias("last_ds"), "yhat", "yhat_lower", "yhat_upper",
        horizon_bucket(F.date_diff("ds", "cutoff")).alias("horizon_days"))
