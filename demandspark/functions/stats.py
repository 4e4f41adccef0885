"""Forecast error aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _complete(actual: Column, predicted: Column) -> Column:
    return F.count_if(actual.isNotNull() & predicted.isNull()) == 0


def mape(actual: Column, predicted: Column) -> Column:
    """Mean absolute percentage error x 100 over rows with a non-zero actual.

    Null if no such row is left or if a prediction is missing.
    """
    error = F.abs(F.try_divide(actual - predicted, F.nullif(actual, F.lit(0))))
    return F.when(_complete(actual, predicted), F.avg(error) * 100)


def rmse(actual: Column, predicted: Column) -> Column:
    """Root mean squared error over all rows; null if a prediction is missing."""
    error = (actual - predicted).cast("double")
    return F.when(_complete(actual, predicted), F.sqrt(F.avg(error * error)))
