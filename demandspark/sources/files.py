"""CSV and Parquet sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import HISTORY_CSV

MART_COLUMNS = ("ds", "product_category", "y", "revenue", "avg_unit_price", "promotion_rate",
                "rolling_avg_units_7d", "rolling_avg_units_30d", "wow_growth_rate")

# Text patterns of each column type, tried in this order (fixed values).
TYPE_PATTERNS = (
    ("bigint", r"^-?[0-9]+$"),
    ("double", r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$"),
    ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    ("timestamp_ntz", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2})?$"),
)


def read_history_csv(spark: SparkSession, path: str) -> DataFrame:
    """The seven-column sales history with a fixed schema."""
    return spark.read.csv(path, header=True, schema=HISTORY_CSV)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with column types found from the text of every row.

    One aggregate decides all columns (one row reaches the driver); empty values do not count,
    and a column without values stays text. A type is taken only if every value fits it: numbers
    too large for a bigint make a column of doubles, an impossible date makes it text.
    """
    raw = spark.read.csv(path, header=True, inferSchema=False)
    checks = [F.count(_text(c)).alias(f"{i}|n") for i, c in enumerate(raw.columns)]
    checks += [F.count_if(~_text(c).rlike(pattern) | (_text(c).isNotNull() & _text(c).try_cast(kind).isNull())).alias(f"{i}|{kind}")
               for i, c in enumerate(raw.columns) for kind, pattern in TYPE_PATTERNS]
    found = raw.agg(*checks).first().asDict()
    columns = []
    for i, name in enumerate(raw.columns):
        kinds = [kind for kind, _ in TYPE_PATTERNS if found[f"{i}|n"] and not found[f"{i}|{kind}"]]
        columns.append(_text(name).cast(kinds[0]).alias(name) if kinds else F.col(f"`{name}`"))
    return raw.select(*columns)


def _text(name: str) -> Column:
    return F.nullif(F.col(f"`{name}`"), F.lit(""))


def read_mart(spark: SparkSession, path: str, columns: Sequence[str] = MART_COLUMNS,
              model: str | None = None) -> DataFrame:
    """The forecast mart (or a forecast table of one model), pruned to ``columns``."""
    table = spark.read.parquet(path)
    if model is not None:
        table = table.filter(F.col("model_name") == model)
    return table.select(*columns)


def write_csv(df: DataFrame, path: str, order_by: Sequence[str | Column] = ()) -> None:
    """CSV export with a header; ordered across files when ``order_by`` is given."""
    (df.orderBy(*order_by) if order_by else df).write.mode("overwrite").option("header", True).csv(path)
