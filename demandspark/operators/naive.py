"""Seasonal-naive forecast: the value 364 days earlier times trailing-year growth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import HOLDOUT_DAYS, HORIZONS, SEASON_LAG
from .features import by_series, shift_days, time_split
from .rollups import SERIES


def _growth_columns() -> dict[str, Column]:
    """Sums of the last 364 days up to the cutoff and of the 364 days before, and their ratio.

    The ratio is null unless both years are complete.
    """
    age = F.date_diff("cutoff", "ds")
    recent = age.between(0, SEASON_LAG - 1)
    earlier = age.between(SEASON_LAG, 2 * SEASON_LAG - 1)
    full = (F.count_if(recent) == SEASON_LAG) & (F.count_if(earlier) == SEASON_LAG)
    recent_units = F.sum(F.when(recent, F.col("y")))
    earlier_units = F.sum(F.when(earlier, F.col("y")))
    return {"recent_units": recent_units, "earlier_units": earlier_units,
            "growth": F.when(full, F.try_divide(recent_units.cast("double"), earlier_units.cast("double")))}


def trailing_growth(df: DataFrame, horizon: int = HOLDOUT_DAYS) -> DataFrame:
    """Trailing-year growth per series at its cutoff (``horizon`` = 0: at its last day)."""
    return time_split(df, horizon).groupBy(SERIES).agg(*[c.alias(n) for n, c in _growth_columns().items()])


def seasonal_naive(df: DataFrame, horizon: int = HOLDOUT_DAYS) -> DataFrame:
    """Holdout predictions. One exchange by series serves the cutoff, the shift and the growth."""
    age = F.date_diff("cutoff", "ds")
    recent, earlier = age.between(0, SEASON_LAG - 1), age.between(SEASON_LAG, 2 * SEASON_LAG - 1)

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("y"))).over(by_series())

    full = F.count(F.when(recent | earlier, 1)).over(by_series()) == 2 * SEASON_LAG
    split = shift_days(time_split(df, horizon)).withColumn(
        "growth", F.when(full, F.try_divide(total(recent).cast("double"), total(earlier).cast("double"))))
    return split.filter("is_holdout").select(
        "ds", SERIES, "y", (F.col(f"y_{SEASON_LAG}d_ago") * F.col("growth")).alias("yhat"))


def horizon_bucket(days_out: Column) -> Column:
    """Smallest of 30, 60 and 90 that covers the number of days ahead."""
    first, *rest = HORIZONS
    bucket = F.when(days_out <= first, first)
    for h in rest:
        bucket = bucket.when(days_out <= h, h)
    return bucket


def check_horizon(horizon: int) -> None:
    """Days beyond the last bucket would drop out of the tables made by bucket, so they are refused."""
    if horizon > HORIZONS[-1]:
        raise ValueError(f"horizon must be at most {HORIZONS[-1]} days")


def seasonal_naive_forward(df: DataFrame, horizon: int = HOLDOUT_DAYS) -> DataFrame:
    """Forecast of the days after the last one, from the whole history.

    A day of the last year shifted by 364 days is the day it predicts, so future days are made
    from history rows directly.
    """
    check_horizon(horizon)
    whole = time_split(df, 0)
    age = F.date_diff("cutoff", "ds")
    growth = trailing_growth(df, 0).select(SERIES, "growth")
    source = whole.filter(age.between(SEASON_LAG - horizon, SEASON_LAG - 1))
    days_out = F.date_diff("ds", "last_ds")
    return (source.join(growth, SERIES)
            .select(F.date_add("ds", SEASON_LAG).alias("ds"), SERIES, F.col("cutoff").alias("last_ds"),
                    F.greatest(F.col("y") * F.col("growth"), F.lit(0.0)).alias("yhat"))
            .withColumn("horizon_days", horizon_bucket(days_out)))
