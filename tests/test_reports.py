from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from demandspark.functions import format_money, format_pct_change, metric_key, slug
from demandspark.operators import dashboard, facts
from tests.conftest import rows_of

METRICS = "product_category string, model string, mape double, rmse double"


@pytest.fixture
def metrics(spark):
    return spark.createDataFrame([("A", "trend_season", 10.004, 1.0), ("A", "seasonal_naive", 10.001, 1.0),
                                  ("B", "trend_season", 14.0, 2.0), ("B", "seasonal_naive", 12.0, 2.25)], METRICS)


def text(spark, column):
    return spark.range(1).select(column.alias("t")).first().t


def test_formats(spark):
    assert text(spark, format_money(F.lit(37_555_732.5))) == "$37.6M"
    assert text(spark, format_money(F.lit(12_345.6))) == "$12,346"
    assert text(spark, format_money(F.lit(1_234_567_890.0))) == "$1234.6M"
    assert text(spark, format_pct_change(F.lit(0.1124))) == "+11.2%"
    assert text(spark, format_pct_change(F.lit(-0.5))) == "-50.0%"
    assert text(spark, slug(F.lit("Home & Garden"))) == "home-and-garden"
    assert text(spark, metric_key(F.lit("a&b:c"))) == "a_b_c"
    assert len(text(spark, metric_key(F.repeat(F.lit("x"), 300)))) == 250
    long = F.repeat(F.lit("x"), 300)
    assert text(spark, metric_key(F.concat(long, F.lit("a")))) != text(spark, metric_key(F.concat(long, F.lit("b"))))


def test_year_over_year_clamps_leap_day(spark):
    frame = spark.createDataFrame([(date(2023, 2, 28), "A", 10), (date(2024, 2, 29), "A", 15)],
                                  "ds date, product_category string, y bigint")
    trend = facts.yoy_trend(frame, 1).first()
    assert (trend.recent_avg, trend.year_earlier_avg, trend.yoy_pct) == (15.0, 10.0, 50.0)


def test_ranking(spark):
    trend = spark.createDataFrame([("A", 5.0), ("B", -1.0), ("C", 9.0), ("D", -7.0), ("E", 0.0), ("F", None)],
                                  "product_category string, yoy_pct double")
    got = rows_of(facts.yoy_ranking(trend), "direction", "position", "product_category")
    assert got == [("declining", 1, "D"), ("declining", 2, "B"), ("growing", 1, "C"), ("growing", 2, "A")]


def test_model_facts(metrics):
    # 10.004 and 10.001 are equal at two decimals: the first model in order wins.
    assert rows_of(facts.best_model(metrics), "product_category", "best_model") == [("A", "trend_season"), ("B", "seasonal_naive")]
    assert rows_of(facts.win_counts(metrics), "model", "wins", "n_series") == [("seasonal_naive", 1, 2), ("trend_season", 1, 2)]
    assert rows_of(facts.beats(metrics, "seasonal_naive", "trend_season"), "product_category") == [("B",)]


@pytest.mark.parametrize("second, code", [(12.4, "tie"), (12.5, "use_primary"), (11.0, "switch")])
def test_recommendation(spark, second, code):
    frame = spark.createDataFrame([("A", "trend_season", 12.0, 1.0), ("A", "seasonal_naive", second, 1.0)], METRICS)
    assert facts.recommendation(frame).first().recommendation == code


def test_a_model_without_wins_is_listed(spark):
    frame = spark.createDataFrame([("A", "trend_season", 1.0, 1.0), ("A", "seasonal_naive", 2.0, 1.0)], METRICS)
    assert rows_of(facts.win_counts(frame), "model", "wins") == [("seasonal_naive", 0), ("trend_season", 1)]


def test_labels_and_rounding(metrics):
    shown = dashboard.display_comparison(metrics)
    assert rows_of(shown.filter("product_category = 'B'"), "model", "rmse") == [("Seasonal Naive", 2.2), ("Trend + Season", 2.0)]
    assert {r.model for r in dashboard.heatmap(shown).collect()} == {"Naive", "Trend + Season"}
    with pytest.raises(PySparkException, match="no display label"):
        dashboard.label(metrics, "model", {"trend_season": "T"}).collect()


def test_horizon_sums_and_means(spark):
    fc = spark.createDataFrame([("A", h, 1.0 * h) for h in (30, 60, 90)],
                               "product_category string, horizon_days int, yhat double")
    assert tuple(dashboard.next_90(fc).first())[1:] == (30.0, 90.0, 180.0)
    assert tuple(facts.horizon_summary(fc).first())[1:] == (30.0, 60.0, 90.0)


def test_monthly_tables(spark):
    months = [(date(y, m, 1), c, units, 2.0 * units) for y in (2022, 2023) for m in range(1, 13)
              for c, units in (("A", 100 * m), ("B", 300))]
    monthly = spark.createDataFrame(months, "sales_month date, product_category string, units_sold bigint, revenue double") \
        .withColumn("revenue", F.col("revenue").cast("decimal(24,2)"))
    share = rows_of(dashboard.revenue_share(monthly), "product_category", "revenue_label")
    assert share == [("A", "$31,200 (68%)"), ("B", "$14,400 (32%)")]
    q4 = dashboard.q4_yoy(monthly).first()
    assert (q4.q4_units, q4.q4_yoy) == (3300 + 900, 0.0)
    index = {r.month: r.seasonal_index for r in dashboard.seasonal_index(monthly).filter("product_category = 'B'").collect()}
    assert index["Feb"] > index["Jan"] and abs(sum(index.values()) - 1200) <= 6
    next90 = spark.createDataFrame([("A", 660.0)], "product_category string, forecast_units_90d double")
    row = dashboard.next_90_growth(next90, monthly).first()
    assert row.growth_label == "660 (+10.0%)"
    metrics = spark.createDataFrame([("A", "m", 12.345, 1.0)], METRICS)
    kpi = dashboard.kpis(monthly, next90, metrics, ["m"]).first()
    assert (kpi.total_revenue, kpi.forecast_90d, kpi.mape_m) == ("$45,600", "660", "12.35%")
