"""Daily totals and their rolling means and weekly growth.

Every window of a series uses the same partition and the same order column, so that Spark
plans one exchange and one sort for all of them. Windows run on daily rows only: a series
never has more rows than calendar days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import AVERAGE, MONEY_TOTAL, RATE

SERIES = "product_category"


def daily_totals(events: DataFrame) -> DataFrame:
    """Units and revenue per day and category."""
    return events.groupBy("event_date", "product_category").agg(
        F.sum("units_sold").alias("daily_units"),
        F.sum("revenue").cast(MONEY_TOTAL).alias("daily_revenue"))


def daily_mix(events: DataFrame) -> DataFrame:
    """Units, revenue, revenue-weighted price, share of promoted events and number of regions."""
    mix = events.groupBy("event_date", "product_category").agg(
        F.sum("units_sold").alias("units_sold"),
        F.sum("revenue").cast(MONEY_TOTAL).alias("revenue"),
        F.avg(F.col("promotion_flag").cast("int")).alias("promotion_rate"),
        F.count_distinct("store_region").alias("region_count"))
    price = F.try_divide(F.col("revenue").cast("double"), F.col("units_sold").cast("double"))
    return mix.withColumn("avg_unit_price", price).select(
        "event_date", "product_category", "units_sold", "revenue", "avg_unit_price", "promotion_rate",
        "region_count")


def range_mean(value: str, days: int, date: str = "event_date", series: str = SERIES) -> Column:
    """Mean over the last ``days`` calendar days; shorter at the start of the series."""
    return F.expr(f"avg(`{value}`) OVER (PARTITION BY `{series}` ORDER BY `{date}` "
                  f"RANGE BETWEEN INTERVAL {days - 1} DAYS PRECEDING AND CURRENT ROW)")


def value_days_ago(value: str, days: int, date: str = "event_date", series: str = SERIES) -> Column:
    """Value exactly ``days`` calendar days earlier, null if that day is missing."""
    return F.expr(f"first_value(`{value}`) OVER (PARTITION BY `{series}` ORDER BY `{date}` "
                  f"RANGE BETWEEN INTERVAL {days} DAYS PRECEDING AND INTERVAL {days} DAYS PRECEDING)")


def growth(value: Column, base: Column) -> Column:
    """(value - base) / base as a double; null when the base is missing or zero."""
    return F.try_divide((value - base).cast("double"), base.cast("double"))


def rolling_mean(daily: DataFrame, days: int, value: str = "daily_units", out: str | None = None) -> DataFrame:
    return daily.withColumn(out or f"rolling_avg_units_{days}d", range_mean(value, days))


def wow_rows(daily: DataFrame, value: str = "daily_units") -> DataFrame:
    """Growth against the value seven *rows* earlier (seven days only in a gap-free series)."""
    by_date = Window.partitionBy(SERIES).orderBy("event_date")
    return daily.withColumn("wow_growth_rate", growth(F.col(value), F.lag(value, 7).over(by_date)))


def wow_days(daily: DataFrame, value: str = "daily_units") -> DataFrame:
    """Growth against the value seven *calendar days* earlier."""
    return daily.withColumn("wow_growth_rate", growth(F.col(value), value_days_ago(value, 7)))


def with_trends(daily: DataFrame, value: str, series: str = SERIES) -> DataFrame:
    """Both rolling means and the weekly growth, cast to their table types, in one window pass."""
    by_date = Window.partitionBy(series).orderBy("event_date")
    windows = daily.withColumns({
        "rolling_avg_units_7d": range_mean(value, 7, series=series),
        "rolling_avg_units_30d": range_mean(value, 30, series=series),
        "_week_ago": F.lag(value, 7).over(by_date)})
    return windows.withColumns({
        "rolling_avg_units_7d": F.col("rolling_avg_units_7d").cast(AVERAGE),
        "rolling_avg_units_30d": F.col("rolling_avg_units_30d").cast(AVERAGE),
        "wow_growth_rate": growth(F.col(value), F.col("_week_ago")).cast(RATE)}).drop("_week_ago")


def rollups(events: DataFrame) -> DataFrame:
    """Daily rollup of deduplicated events: totals, 7- and 30-day means, week-over-week growth."""
    return with_trends(daily_totals(events), "daily_units")
