"""Scores, model comparison, intervals and the long actual/backtest/forecast table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import mape, metric_key, rmse
from ..schemas import HOLDOUT_DAYS, MODEL_ORDER
from .features import with_cutoff
from .rollups import SERIES

METRIC_COLUMNS = (SERIES, "model", "mape", "rmse")


def score_frame(actual: DataFrame, predicted: DataFrame) -> DataFrame:
    """Actual and predicted value of each holdout day that has both rows."""
    return actual.select("ds", SERIES, "y").join(predicted.select("ds", SERIES, "yhat"), ["ds", SERIES])


def score(predictions: DataFrame, model: str | Column) -> DataFrame:
    """MAPE and RMSE per series of a frame with ``y`` and ``yhat``; ``model`` names them, or is a
    column of the frame."""
    name = F.lit(model) if isinstance(model, str) else model
    return predictions.groupBy(SERIES, name.alias("model")).agg(
        mape(F.col("y"), F.col("yhat")).alias("mape"), rmse(F.col("y"), F.col("yhat")).alias("rmse"))


def union_metrics(*metrics: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), metrics)


def model_position(model: Column, order: Mapping[str, int] = MODEL_ORDER) -> Column:
    positions = F.create_map(*[F.lit(v) for pair in order.items() for v in pair])
    return F.coalesce(F.try_element_at(positions, model), F.lit(len(order)))


def model_comparison(*metrics: DataFrame, order: Mapping[str, int] = MODEL_ORDER) -> DataFrame:
    """All metrics in one table, models in their fixed order, then series."""
    return union_metrics(*metrics).select(*METRIC_COLUMNS).orderBy(model_position(F.col("model"), order), "model", SERIES)


def model_means(metrics: DataFrame) -> DataFrame:
    """Unweighted mean over the series, per model."""
    return metrics.groupBy("model").agg(F.avg("mape").alias("mean_mape"), F.avg("rmse").alias("mean_rmse"),
                                        F.count("mape").alias("n_series"))


def winner(metrics: DataFrame) -> DataFrame:
    """One row: the model with the lowest mean MAPE (first name on a tie)."""
    return model_means(metrics).filter(F.col("mean_mape").isNotNull()).agg(
        F.min_by("model", F.struct("mean_mape", "model")).alias("model"), F.min("mean_mape").alias("mean_mape"))


def interval(predictions: DataFrame, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """Residual quantiles of the holdout, per series; add them to a forecast for its interval."""
    residual = F.col("y") - F.col("yhat")
    return predictions.groupBy(SERIES).agg(
        F.percentile(residual, F.lit(low)).alias("residual_low"),
        F.percentile(residual, F.lit(high)).alias("residual_high"))


def with_interval(forecast: DataFrame, residuals: DataFrame) -> DataFrame:
    """Forecast with lower and upper bounds, never below zero."""
    return forecast.join(residuals, SERIES).withColumns({
        "yhat_lower": F.greatest(F.col("yhat") + F.col("residual_low"), F.lit(0.0)),
        "yhat_upper": F.greatest(F.col("yhat") + F.col("residual_high"), F.lit(0.0))
    }).drop("residual_low", "residual_high")


def forecast_vs_actual(series: DataFrame, backtest: DataFrame, forecast: DataFrame,
                       history_days: int = HOLDOUT_DAYS, horizon: int = HOLDOUT_DAYS) -> DataFrame:
    """Recent actuals, holdout predictions and forward forecast in one long table.

    Actuals start ``history_days`` before the cutoff. Values are never below zero; actuals have
    no bounds.
    """
    def clipped(name: str, out: str) -> Column:
        return F.greatest(F.col(name).cast("double"), F.lit(0.0)).alias(out)

    recent = with_cutoff(series, horizon).filter(F.col("ds") > F.date_sub("cutoff", history_days))
    none = F.lit(None).cast("double")
    parts = [recent.select("ds", SERIES, F.lit("Actual").alias("series"), clipped("y", "units"),
                           none.alias("units_lower"), none.alias("units_upper"))]
    for name, frame in (("Backtest", backtest), ("Forecast", forecast)):
        bounds = [clipped(f"yhat_{b}", f"units_{b}") if f"yhat_{b}" in frame.columns else none.alias(f"units_{b}")
                  for b in ("lower", "upper")]
        parts.append(frame.select("ds", SERIES, F.lit(name).alias("series"), clipped("yhat", "units"), *bounds))
    return union_metrics(*parts)


def flatten_metrics(metrics: DataFrame, values: Sequence[str] = ("mape", "rmse")) -> DataFrame:
    """Wide metrics as long key/value rows: ``<model>.<series>.<metric>``, keys cleaned."""
    long = metrics.unpivot([SERIES, "model"], list(values), "metric", "value")
    key = F.concat_ws(".", "model", SERIES, "metric")
    return long.filter(F.col("value").isNotNull()).select(metric_key(key).alias("key"), "value")
