"""JDBC scans and full replacement."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Split(NamedTuple):
    """A numeric, date or timestamp column and its bounds, to read a table in parallel."""

    column: str
    lower: str | int
    upper: str | int
    partitions: int


def read_options(table: str, split: Split | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    options = {"dbtable": table, "fetchsize": str(fetch_size)}
    if split is not None:
        options |= {"partitionColumn": split.column, "lowerBound": str(split.lower),
                    "upperBound": str(split.upper), "numPartitions": str(split.partitions)}
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, props: dict[str, str] | None = None,
              split: Split | None = None) -> DataFrame:
    """A table scan; with ``split`` one task per range instead of one for the whole table."""
    return spark.read.format("jdbc").options(url=url, **(props or {}), **read_options(table, split)).load()


def write_jdbc_replace(df: DataFrame, url: str, table: str, props: dict[str, str] | None = None,
                       connections: int = 16, batch_size: int = 10_000) -> None:
    """Replace all rows but keep the table (truncate, not drop), so its keys stay."""
    (df.coalesce(connections).write.format("jdbc")
       .options(url=url, dbtable=table, truncate="true", batchsize=str(batch_size), **(props or {}))
       .mode("overwrite").save())
