"""Splits and features for direct 90-day-ahead forecasts.

Input is a gap-free daily series per category (``ds``, ``product_category``, ``y``). No feature
uses a value of ``y`` closer than 90 days to the day it describes, so every day of the holdout
is described only by what was known at the cutoff.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import calendar_columns, holiday_code
from ..schemas import HOLDOUT_DAYS, LEVEL_WINDOW, MIN_LAG, SEASON_LAG
from .rollups import SERIES, value_days_ago

CALENDAR_FEATURES = ("dayofweek", "month", "day", "dayofyear", "weekofyear", "is_weekend")
RATIO_FEATURES = ("level_yoy_growth", f"ly_ratio_{SEASON_LAG - 7}", f"ly_ratio_{SEASON_LAG}",
                  f"ly_ratio_{SEASON_LAG + 7}", "ly_week_ratio")
FEATURES = (*CALENDAR_FEATURES, "us_holiday", *RATIO_FEATURES)


def by_series() -> WindowSpec:
    return Window.partitionBy(SERIES)


def by_day() -> WindowSpec:
    return Window.partitionBy(SERIES).orderBy("ds")


def with_cutoff(df: DataFrame, horizon: int = HOLDOUT_DAYS) -> DataFrame:
    """Last training day of each series: ``horizon`` days before its last day."""
    return df.withColumn("cutoff", F.date_sub(F.max("ds").over(by_series()), horizon))


def time_split(df: DataFrame, horizon: int = HOLDOUT_DAYS) -> DataFrame:
    """Mark the days after the cutoff as holdout."""
    return with_cutoff(df, horizon).withColumn("is_holdout", F.col("ds") > F.col("cutoff"))


def calendar_features(df: DataFrame) -> DataFrame:
    return df.withColumns(calendar_columns(F.col("ds")))


def with_holidays(df: DataFrame) -> DataFrame:
    """Number of the US public holiday on each day, 0 if none."""
    return df.withColumn("us_holiday", holiday_code(F.col("ds")))


def full_mean(value: str, lag: int, width: int) -> Column:
    """Mean of ``width`` rows ending ``lag`` rows earlier, null until all of them exist."""
    frame = by_day().rowsBetween(-(lag + width - 1), -lag)
    return F.when(F.count(value).over(frame) == width, F.avg(value).over(frame))


def lagged_level(df: DataFrame, lag: int = MIN_LAG, width: int = LEVEL_WINDOW) -> DataFrame:
    """Level known at forecast time, and the same level one season earlier."""
    return df.withColumns({"level": full_mean("y", lag, width),
                           "level_last_year": full_mean("y", lag + SEASON_LAG, width)})


def shift_days(df: DataFrame, days: int = SEASON_LAG, value: str = "y") -> DataFrame:
    """Value exactly ``days`` calendar days earlier, without a self-join."""
    return df.withColumn(f"{value}_{days}d_ago", value_days_ago(value, days, "ds"))


def lag_features(df: DataFrame) -> DataFrame:
    """Level, its yearly growth, last year's values relative to last year's level, and the target
    ratio. All windows share one exchange and one sort."""
    lags = (SEASON_LAG - 7, SEASON_LAG, SEASON_LAG + 7)
    windows = lagged_level(df).withColumns(
        {f"_lag_{n}": F.lag("y", n).over(by_day()) for n in lags} | {"_week": full_mean("y", SEASON_LAG - 3, 7)})
    base = F.col("level_last_year")

    def ratio(value: str, to: Column) -> Column:
        return F.try_divide(F.col(value).cast("double"), to.cast("double"))

    features = {"level_yoy_growth": ratio("level", base)}
    features |= {f"ly_ratio_{n}": ratio(f"_lag_{n}", base) for n in lags}
    features |= {"ly_week_ratio": ratio("_week", base), "target_ratio": ratio("y", F.col("level"))}
    return windows.withColumns(features).drop("level_last_year", "_week", *[f"_lag_{n}" for n in lags])


def make_features(df: DataFrame, horizon: int = HOLDOUT_DAYS) -> DataFrame:
    """Every feature of a series, with its cutoff and holdout flag."""
    return with_holidays(calendar_features(lag_features(time_split(df, horizon))))


def _has_null(columns) -> Column:
    found = F.lit(False)
    for c in columns:
        found = found | F.col(c).isNull()
    return found


def _usable_rows() -> dict[str, Column]:
    """Per series: usable training rows, holdout rows, and holdout rows that lack a feature."""
    usable = ~_has_null([*RATIO_FEATURES, "target_ratio"])
    return {"train_rows": F.count_if(~F.col("is_holdout") & usable), "test_rows": F.count_if("is_holdout"),
            "incomplete_test_rows": F.count_if(F.col("is_holdout") & _has_null([*RATIO_FEATURES, "level"]))}


def eligible(features: DataFrame, min_train: int = 60) -> DataFrame:
    """Usable training rows and holdout rows per series, and whether the series can be modelled:
    enough training rows, a holdout, and no missing feature in it."""
    counts = features.groupBy(SERIES).agg(*[column.alias(name) for name, column in _usable_rows().items()])
    return counts.withColumn("is_eligible", (F.col("train_rows") >= min_train) & (F.col("test_rows") > 0)
                             & (F.col("incomplete_test_rows") == 0))


def eligible_rows(features: DataFrame, min_train: int = 60) -> DataFrame:
    """The rows of the series that ``eligible`` admits, flagged in the pass that made the features: a series is in one
    partition already, so no further exchange or scan is needed."""
    whole = Window.partitionBy(SERIES)
    counts = {name: column.over(whole) for name, column in _usable_rows().items()}
    admitted = (counts["train_rows"] >= min_train) & (counts["test_rows"] > 0) & (counts["incomplete_test_rows"] == 0)
    return features.withColumn("_admitted", admitted).filter("_admitted").drop("_admitted")


def rolling_origins(df: DataFrame, initial: int, period: int, horizon: int = HOLDOUT_DAYS) -> DataFrame:
    """Cutoffs of a rolling-origin evaluation, one row per series and origin.

    The last origin lies ``horizon`` days before the end; earlier ones follow every ``period``
    days while at least ``initial`` days of history remain before them.
    """
    span = df.groupBy(SERIES).agg(F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"))
    newest = F.date_sub("last_ds", horizon)
    oldest = F.date_add("first_ds", initial)
    steps = F.floor(F.date_diff(newest, oldest) / period).cast("int")
    origins = F.transform(F.sequence(F.lit(0), steps), lambda k: F.date_sub(newest, k * period))
    return span.filter(newest >= oldest).select(SERIES, F.explode(origins).alias("cutoff"))


def future_frame(df: DataFrame, horizon: int = HOLDOUT_DAYS) -> DataFrame:
    """The ``horizon`` days after the last day of each series."""
    last = df.groupBy(SERIES).agg(F.max("ds").alias("last_ds"))
    days = F.sequence(F.date_add("last_ds", 1), F.date_add("last_ds", horizon))
    return last.select(SERIES, "last_ds", F.explode(days).alias("ds"))
