"""Star schema: daily category table, dimension, fact and forecast mart; monthly aggregates."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DAILY_KEY, DEFAULT_PROFILE, MONEY_TOTAL, SEASONALITY_PROFILES
from .indexing import with_row_index
from .rollups import daily_mix, with_trends

TRENDS = ("rolling_avg_units_7d", "rolling_avg_units_30d", "wow_growth_rate")


def daily_category(mix: DataFrame, rollup: DataFrame) -> DataFrame:
    """Daily mix with the rollup columns of the same day and category, null where none exists."""
    return mix.join(rollup.select(*DAILY_KEY, *TRENDS), list(DAILY_KEY), "left")


def daily_category_from_events(events: DataFrame) -> DataFrame:
    """The same table straight from deduplicated events: one aggregate, no join."""
    return with_trends(daily_mix(events), "units_sold")


def seasonality_profile(category: Column) -> Column:
    pairs = [(F.lit(c), F.lit(profile)) for profile, names in SEASONALITY_PROFILES.items() for c in names]
    profiles = F.create_map(*chain.from_iterable(pairs))
    return F.coalesce(F.try_element_at(profiles, category), F.lit(DEFAULT_PROFILE))


def dim_category(daily: DataFrame) -> DataFrame:
    """One row per category: dense id over the sorted names and seasonality profile.

    Ids move when a category is added; ``category_key`` is a stable alternative.
    """
    names = daily.select("product_category").distinct()
    return with_row_index(names, ["product_category"], "category_id").select(
        "category_id", "product_category", seasonality_profile(F.col("product_category")).alias("seasonality_profile"))


def category_key(category: Column) -> Column:
    return F.xxhash64(category)


def fact_daily_sales(daily: DataFrame, dim: DataFrame) -> DataFrame:
    """Daily table with the category id."""
    return daily.join(dim.select("product_category", "category_id"), "product_category", "left").select(
        "category_id", "product_category", "event_date", "units_sold", "revenue", "avg_unit_price",
        "promotion_rate", *TRENDS)


def forecast_mart(fact: DataFrame) -> DataFrame:
    """Fact columns under the names forecasting uses (``ds``, ``y``)."""
    return fact.select(F.col("event_date").alias("ds"), "product_category", F.col("units_sold").alias("y"),
                       "revenue", "avg_unit_price", "promotion_rate", *TRENDS)


def monthly_category(mart: DataFrame) -> DataFrame:
    """Units and revenue per month and category."""
    month = F.trunc("ds", "MM").alias("sales_month")
    return mart.groupBy(month, "product_category").agg(
        F.sum("y").alias("units_sold"), F.sum("revenue").cast(MONEY_TOTAL).alias("revenue"))


def monthly_total(monthly: DataFrame) -> DataFrame:
    """Revenue per month over all categories."""
    return monthly.groupBy("sales_month").agg(F.sum("revenue").cast(MONEY_TOTAL).alias("total_revenue"))


def category_totals(events: DataFrame) -> DataFrame:
    """Units per category, largest first."""
    return events.groupBy("product_category").agg(F.sum("units_sold").alias("units_sold")) \
        .orderBy(F.desc("units_sold"), "product_category")


def month_by_category(events: DataFrame, categories: list[str]) -> DataFrame:
    """Mean units per event for each calendar month, one column per category."""
    return events.groupBy(F.month("event_date").alias("month")).pivot("product_category", categories) \
        .agg(F.avg("units_sold"))


def series_span(mart: DataFrame) -> DataFrame:
    """First and last day, number of calendar days and number of rows per series."""
    return mart.groupBy("product_category").agg(
        F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"), F.count("*").alias("n_rows")
    ).withColumn("span_days", F.date_diff("last_ds", "first_ds") + 1)
