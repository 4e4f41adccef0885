"""Tables behind the dashboards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import format_money, format_pct_change, format_thousands
from ..schemas import HORIZONS, MODEL_LABELS, SERIES_CODES
from .evaluation import model_means
from .rollups import SERIES
from .scalars import row_of, value_of


def next_90(forecast: DataFrame) -> DataFrame:
    """Forecast units per series, summed up to day 30, 60 and 90 (cumulative), whole units."""
    sums = [F.round(F.sum(F.when(F.col("horizon_days") <= h, F.col("yhat")))).alias(f"forecast_units_{h}d")
            for h in HORIZONS]
    return forecast.groupBy(SERIES).agg(*sums)


def next_90_sorted(next90: DataFrame) -> DataFrame:
    """Largest 90-day forecast first."""
    return next90.select(SERIES, "forecast_units_90d").orderBy(F.desc("forecast_units_90d"), SERIES)


def label(df: DataFrame, col: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace codes by display labels; a code without a label stops the job."""
    pairs = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    found = F.try_element_at(pairs, F.col(col))
    unknown = F.raise_error(F.concat(F.lit(f"no display label for {col} "), F.coalesce(F.col(col), F.lit("null"))))
    return df.withColumn(col, F.when(found.isNull(), unknown.cast("string")).otherwise(found))


def display_comparison(metrics: DataFrame, labels: Mapping[str, str] = MODEL_LABELS) -> DataFrame:
    """Model comparison for display: labels, MAPE with 2 and RMSE with 1 decimal (half-even)."""
    shown = label(metrics, "model", labels)
    return shown.select(SERIES, "model", F.bround("mape", 2).alias("mape"), F.bround("rmse", 1).alias("rmse"))


def heatmap(display: DataFrame, short: Mapping[str, str] = {"Seasonal Naive": "Naive"}) -> DataFrame:  # noqa: B006
    """MAPE with 1 decimal under short model names."""
    name = F.col("model")
    for long_name, short_name in short.items():
        name = F.when(F.col("model") == long_name, short_name).otherwise(name)
    return display.select(SERIES, name.alias("model"), F.bround("mape", 1).alias("mape"))


def mape_wide(metrics: DataFrame, models: Sequence[str]) -> DataFrame:
    """One row per series with the MAPE of each model as a column."""
    return metrics.groupBy(SERIES).pivot("model", list(models)).agg(F.first("mape"))


def monthly_revenue_m(monthly_total: DataFrame) -> DataFrame:
    """Monthly revenue in millions, 2 decimals (half-even)."""
    return monthly_total.select("sales_month", F.bround(F.col("total_revenue").cast("double") / 1e6, 2).alias("revenue_m"))


def vs_group_mean(df: DataFrame, value: str, group: Sequence[str], out: str) -> DataFrame:
    """Value as a percentage of the mean of its group. For aggregated tables: a group is one window."""
    mean = F.avg(value).over(Window.partitionBy(*group))
    return df.withColumn(out, F.try_divide(F.col(value) * 100, mean))


def seasonal_index(monthly: DataFrame) -> DataFrame:
    """Mean daily units of each calendar month against the mean of the series' months, in percent.

    Per day, so that short months are not lower for being short.
    """
    days = F.dayofmonth(F.last_day("sales_month"))
    per_month = monthly.groupBy(SERIES, F.month("sales_month").alias("moy")).agg(
        F.avg(F.col("units_sold") / days).alias("avg_daily_units"))
    index = vs_group_mean(per_month, "avg_daily_units", [SERIES], "_index")
    name = F.date_format(F.make_date(F.lit(2000), F.col("moy"), F.lit(1)), "MMM")
    return index.select(SERIES, "moy", name.alias("month"), F.bround("_index", 0).cast("int").alias("seasonal_index"))


def revenue_share(monthly: DataFrame) -> DataFrame:
    """Revenue per series, with its share of the total as a label like ``$37.6M (15%)``."""
    per_series = monthly.groupBy(SERIES).agg(F.sum("revenue").alias("revenue"))
    total = value_of(monthly.agg(F.sum("revenue")))
    ratio = F.try_divide(F.col("revenue").cast("double"), F.col("_total").cast("double"))
    text = F.concat(format_money(F.col("revenue")), F.lit(" ("), F.format_number(ratio * 100, 0), F.lit("%)"))
    return per_series.withColumn("_total", total).select(
        SERIES, F.col("revenue").cast("decimal(24,2)").alias("revenue"), text.alias("revenue_label"))


def _prior_months(monthly: DataFrame, months: int = 3) -> DataFrame:
    """Units per series in the ``months`` months after the last one, a year earlier."""
    last = value_of(monthly.agg(F.max("sales_month")))
    wanted = F.col("sales_month").between(F.add_months(last, 1 - 12), F.add_months(last, months - 12))
    return monthly.filter(wanted) \
        .groupBy(SERIES).agg(F.sum("units_sold").alias("prior_units"))


def next_90_growth(next90: DataFrame, monthly: DataFrame) -> DataFrame:
    """90-day forecast and its growth over the same calendar months a year earlier, with a label."""
    joined = next90.join(_prior_months(monthly), SERIES, "left")
    growth = F.try_divide(F.col("forecast_units_90d"), F.col("prior_units").cast("double")) - 1
    text = F.concat(format_thousands(F.col("forecast_units_90d")), F.lit(" ("), format_pct_change(growth), F.lit(")"))
    return joined.select(SERIES, "forecast_units_90d", growth.alias("growth"), text.alias("growth_label"))


def q4_yoy(monthly: DataFrame) -> DataFrame:
    """One row: fourth-quarter units of the last year and of the year before, and their growth."""
    last = value_of(monthly.agg(F.year(F.max("sales_month"))))
    quarter4 = F.month("sales_month") >= 10

    def units(back: int) -> Column:
        return F.sum(F.when(quarter4 & (F.year("sales_month") == F.col("_year") - back), F.col("units_sold")))

    totals = monthly.withColumn("_year", last).agg(units(0).alias("q4_units"), units(1).alias("q4_units_prior"))
    return totals.withColumn("q4_yoy", F.try_divide(F.col("q4_units").cast("double"),
                                                    F.col("q4_units_prior").cast("double")) - 1)


def kpis(monthly: DataFrame, next90: DataFrame, metrics: DataFrame, models: Sequence[str]) -> DataFrame:
    """One row of headline figures as display text."""
    totals = monthly.agg(F.sum("revenue").alias("revenue"), F.sum("units_sold").alias("units"))
    ahead = next90.agg(F.sum("forecast_units_90d").alias("ahead"))
    prior = _prior_months(monthly).agg(F.sum("prior_units").alias("prior"))
    errors = model_means(metrics).agg(*[F.max(F.when(F.col("model") == m, F.col("mean_mape"))).alias(f"e{i}")
                                        for i, m in enumerate(models)])
    row = totals.withColumns({"q4_yoy": value_of(q4_yoy(monthly).select("q4_yoy")), "ahead": value_of(ahead),
                              "prior": value_of(prior), "errors": row_of(errors)})
    growth = F.try_divide(F.col("ahead"), F.col("prior").cast("double")) - 1
    return row.select(
        format_money(F.col("revenue")).alias("total_revenue"),
        F.concat(F.format_number(F.col("units").cast("double") / 1e6, 2), F.lit("M")).alias("units_sold"),
        format_pct_change(F.col("q4_yoy")).alias("q4_yoy"),
        format_thousands(F.col("ahead")).alias("forecast_90d"),
        format_pct_change(growth).alias("forecast_growth"),
        *[F.concat(F.format_number(F.col(f"errors.e{i}"), 2), F.lit("%")).alias(f"mape_{m}") for i, m in enumerate(models)])


def backtest_total(fva: DataFrame) -> DataFrame:
    """Actual and backtest units per day inside the backtest window."""
    window = row_of(fva.filter(F.col("series") == "Backtest").agg(F.min("ds").alias("lo"), F.max("ds").alias("hi")))
    inside = fva.filter(F.col("series").isin("Actual", "Backtest")).withColumn("_window", window) \
        .filter(F.col("ds").between(F.col("_window.lo"), F.col("_window.hi")))

    def units(series: str) -> Column:
        return F.sum(F.when(F.col("series") == series, F.col("units")))

    return inside.groupBy("ds").agg(units("Actual").alias("actual_units"), units("Backtest").alias("backtest_units"))


def series_code(fva: DataFrame) -> DataFrame:
    """Plotting position of each series name."""
    code = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in SERIES_CODES.items()))
    return fva.withColumn("series_code", F.try_element_at(code, F.col("series")))
