import math
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from demandspark.functions import calendar_columns, holiday_code, mape, rmse
from demandspark.functions.dates import HOLIDAY_NAMES
from demandspark.operators import evaluation, features, naive, tree, trend
from demandspark.plans import stages
from tests.conftest import rows_of


def wave(n, level=100.0, slope=0.0):
    return [level + slope * i + 20 * math.sin(2 * math.pi * i / 7) + 30 * math.sin(2 * math.pi * i / 365.25)
            for i in range(n)]


def test_split_and_buckets(series):
    s = features.time_split(series({"A": range(200)}))
    assert s.filter("is_holdout").count() == 90
    assert s.filter("not is_holdout").agg(F.max("ds")).first()[0] == date(2020, 1, 1) + timedelta(days=109)
    ahead = features.future_frame(series({"A": range(200)}))
    bucket = {r.d: r.b for r in ahead.select(F.date_diff("ds", "last_ds").alias("d"), naive.horizon_bucket(
        F.date_diff("ds", "last_ds")).alias("b")).collect()}
    assert [bucket[d] for d in (1, 30, 31, 60, 61, 90)] == [30, 30, 60, 60, 90, 90] and len(bucket) == 90


def test_calendar_and_holidays(spark):
    days = {"2023-01-02": "New Year's Day (observed)", "2021-12-31": "New Year's Day (observed)",
            "2023-01-16": "Martin Luther King Jr. Day", "2024-05-27": "Memorial Day", "2020-06-19": None,
            "2022-06-20": "Juneteenth National Independence Day (observed)", "2023-07-04": "Independence Day",
            "2023-11-23": "Thanksgiving Day", "2023-11-10": "Veterans Day (observed)", "2023-12-25": "Christmas Day",
            "2023-09-04": "Labor Day", "2023-10-09": "Columbus Day", "2023-02-20": "Washington's Birthday",
            "2023-03-15": None}
    frame = spark.createDataFrame([(d,) for d in days], "d string").select("d", holiday_code(F.to_date("d")).alias("c"))
    found = {r.d: HOLIDAY_NAMES[r.c - 1] if r.c else None for r in frame.collect()}
    assert found == days
    one = spark.createDataFrame([("2023-01-01",)], "d string").select(
        *[c.alias(n) for n, c in calendar_columns(F.to_date("d")).items()]).first()
    assert tuple(one) == (6, 1, 1, 1, 52, 1)


def test_errors(spark):
    def measure(rows):
        frame = spark.createDataFrame(rows, "y double, p double")
        return frame.agg(mape(F.col("y"), F.col("p")).alias("m"), rmse(F.col("y"), F.col("p")).alias("r")).first()

    got = measure([(10.0, 9.0), (0.0, 3.0)])
    assert got.m == pytest.approx(10.0) and got.r == pytest.approx(math.sqrt(5))
    assert measure([(0.0, 3.0)]).m is None and measure([(0.0, 3.0)]).r == 3.0
    assert measure([(10.0, None), (10.0, 9.0)]).m is None


def test_no_feature_sees_the_last_ninety_days(series):
    base = list(range(100, 900))
    changed = base[:-90] + [7 * v % 1000 for v in base[-90:]]
    def holdout(values):
        rows = features.make_features(series({"A": values})).filter("is_holdout")
        return rows_of(rows, "ds", "level", *features.FEATURES)
    assert holdout(base) == holdout(changed)


def test_features_values_and_eligibility(series):
    values = list(range(1, 801))
    last = features.make_features(series({"A": values})).orderBy(F.desc("ds")).first()
    level = sum(values[-118:-90]) / 28
    level_ly = sum(values[-482:-454]) / 28
    assert last.level == level and last.target_ratio == 800 / level
    assert last.ly_ratio_364 == values[-365] / level_ly and last.level_yoy_growth == level / level_ly
    assert last.ly_week_ratio == sum(values[-368:-361]) / 7 / level_ly
    el = features.eligible(features.make_features(series({"A": values, "B": range(200)})))
    assert rows_of(el, "product_category", "is_eligible") == [("A", True), ("B", False)]


def test_seasonal_naive(series):
    values = [10] * 364 + [20] * 364 + [30] * 90
    out = naive.seasonal_naive(series({"A": values})).collect()
    assert len(out) == 90 and {r.yhat for r in out} == {40.0}
    short = naive.seasonal_naive(series({"A": [5] * 400})).collect()
    assert all(r.yhat is None for r in short)
    assert evaluation.score(naive.seasonal_naive(series({"A": [5] * 400})), "m").first().mape is None


def test_forward_naive_and_interval(series):
    s = series({"A": [10] * 364 + [20] * 364})
    ahead = naive.seasonal_naive_forward(s)
    assert {r.yhat for r in ahead.collect()} == {40.0} and ahead.count() == 90
    assert ahead.agg(F.min("ds"), F.max("ds")).first()[1] == date(2020, 1, 1) + timedelta(days=728 + 89)
    residuals = evaluation.interval(s.withColumn("yhat", F.col("y") - F.lit(-50.0)))
    assert evaluation.with_interval(ahead, residuals).first().yhat_lower == 0.0
    with pytest.raises(ValueError):
        naive.seasonal_naive_forward(s, 400)


def test_rolling_origins(series):
    # 720 training days (0 .. 719): the last origin is day 629, one before it would be day 539.
    s = features.with_cutoff(series({"A": range(810)})).filter("ds <= cutoff").drop("cutoff")
    got = [(r.cutoff - date(2020, 1, 1)).days for r in features.rolling_origins(s, 540, 90).orderBy("cutoff").collect()]
    assert got == [629]
    assert features.rolling_origins(series({"A": range(300)}), 540, 90).isEmpty()


def test_trend_season_recovers_a_known_pattern(series):
    s = series({"A": wave(1200), "B": wave(1200, 500, 0.2)})
    scores = evaluation.score(trend.trend_season(s), "trend_season").collect()
    assert all(r.mape < 6 for r in scores)
    again = evaluation.score(trend.trend_season(s), "trend_season").collect()
    assert sorted(scores) == sorted(again)
    ahead = trend.forecast_forward(s)
    assert ahead.count() == 180 and ahead.filter("yhat < 0 or yhat_lower > yhat_upper").isEmpty()


def test_trend_season_ignores_the_holdout(series):
    base = wave(900)
    a = trend.trend_season(series({"A": base})).select("ds", "yhat")
    b = trend.trend_season(series({"A": base[:-90] + [0] * 90})).select("ds", "yhat")
    assert rows_of(a, "ds", "yhat") == rows_of(b, "ds", "yhat")


def test_tuning(series):
    cv = trend.rolling_cv(series({"A": wave(1000), "B": wave(1000, 300, 0.1)}))
    assert cv.count() == 10 and {r.origins for r in cv.collect()} == {4}
    best = trend.best_param(cv).collect()
    lowest = {c: min((r.cv_mape, r.flexibility) for r in cv.collect() if r.product_category == c)[1] for c in "AB"}
    assert {r.product_category: r.flexibility for r in best} == lowest


def test_folds_from_running_sums_equal_refits(series):
    s = series({"A": wave(1300), "B": wave(1000, 300, 0.1), "C": [(k * k) % 97 for k in range(900)], "short": wave(200)})
    keys = ["product_category", "cutoff", "ds", "flexibility"]
    both = trend.cv_predictions(s).join(trend.cv_refits(s).withColumnRenamed("yhat", "refit").drop("y"), keys, "full_outer").collect()
    assert len(both) == trend.cv_refits(s).count() and {r.product_category for r in both} == {"A", "B", "C"}
    assert all(abs(r.yhat - r.refit) <= 1e-6 * max(1.0, abs(r.refit)) for r in both)


def test_best_param_prefers_the_smaller_on_a_tie(spark):
    cv = spark.createDataFrame([("A", 0.05, 5.0), ("A", 0.01, 5.0), ("A", 0.1, 6.0)],
                               "product_category string, flexibility double, cv_mape double")
    assert trend.best_param(cv).first().flexibility == 0.01


def test_direct_tree(series):
    s = series({"A": wave(1000), "B": [0] * 1000, "C": wave(150)})
    out = tree.direct_tree(s, iterations=5)
    assert rows_of(out.select("product_category").distinct(), "product_category") == [("A",)]
    assert out.filter("yhat < 0 or yhat is null").isEmpty() and out.count() == 90
    assert evaluation.score(out, "direct_tree").first().mape < 25


def test_comparison_order_winner_and_long_table(series, spark):
    schema = "product_category string, model string, mape double, rmse double"
    a = spark.createDataFrame([("B", "seasonal_naive", 2.0, 1.0), ("A", "seasonal_naive", 4.0, 1.0)], schema)
    b = spark.createDataFrame([("A", "trend_season", 1.0, 1.0), ("B", "trend_season", 6.0, 1.0)], schema)
    table = evaluation.model_comparison(a, b)
    assert [(r.model, r.product_category) for r in table.collect()] == [
        ("trend_season", "A"), ("trend_season", "B"), ("seasonal_naive", "A"), ("seasonal_naive", "B")]
    assert evaluation.winner(table).first().model == "seasonal_naive"
    keys = {r.key for r in evaluation.flatten_metrics(a.replace("A", "Home & Garden")).collect()}
    assert "seasonal_naive.Home _ Garden.mape" in keys
    s = series({"A": range(900)})
    long = evaluation.forecast_vs_actual(s, naive.seasonal_naive(s), naive.seasonal_naive_forward(s))
    assert {r["series"]: r["count"] for r in long.groupBy("series").count().collect()} == {
        "Actual": 180, "Backtest": 90, "Forecast": 90}


def test_whole_forecast_stage(series, tmp_path, spark):
    s = series({"A": wave(1000), "B": wave(1000, 300)})
    out = stages.build_forecasts(s, str(tmp_path / "forecast"))
    assert out.metrics.count() == 6 and out.tuning.count() == 2
    stored = spark.read.parquet(str(tmp_path / "forecast"))
    assert stored.count() == 180 and {r.model_name for r in stored.select("model_name").distinct().collect()} == {"trend_season"}
    assert out.long.count() == 2 * (180 + 90 + 90)


def test_series_that_lack_tuning_or_history_stay(series, spark):
    s = series({"LONG": wave(1000), "SHORT": wave(60)})
    chosen = spark.createDataFrame([("LONG", 0.5)], "product_category string, flexibility double")
    ahead = trend.forecast_forward(s, chosen=chosen).groupBy("product_category").agg(F.count("yhat").alias("n"))
    assert rows_of(ahead, "product_category", "n") == [("LONG", 90), ("SHORT", 90)]
    backtest = trend.trend_season(s, chosen=chosen)  # SHORT has no day before the holdout
    assert {r.product_category for r in backtest.select("product_category").distinct().collect()} == {"LONG"}
    status = {r.product_category: r for r in trend.forecast_series_status(s, chosen).collect()}
    assert (status["LONG"].flexibility, status["LONG"].reason, status["LONG"].has_backtest) == (0.5, "tuned", True)
    assert (status["SHORT"].flexibility, status["SHORT"].has_backtest) == (0.05, False)


def test_long_horizons_are_refused(series):
    s = series({"A": wave(800)})
    for forward in (trend.forecast_forward, naive.seasonal_naive_forward):
        with pytest.raises(ValueError):
            forward(s, horizon=120)


def test_series_codes_tell_many_series_apart(spark):
    names = spark.range(5000).select(F.concat(F.lit("s"), "id").alias("product_category")).withColumns(tree._series_codes())
    assert names.select(*tree.SERIES_CODES).distinct().count() == 5000
    assert len(tree.SERIES_CODES) == 3
