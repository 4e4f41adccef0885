"""One-row aggregates as values inside other queries.

Scalar subqueries run once, reach every task as a literal, and fail if there is more than one
row, so nothing that grows with the data can be spread this way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_of(one_row: DataFrame) -> Column:
    """The only column of a global aggregate."""
    return one_row.scalar()


def row_of(one_row: DataFrame) -> Column:
    """All columns of a global aggregate, as a struct."""
    return one_row.select(F.struct("*")).scalar()
