"""Sales events derived from the TPC-H-like test tables, clean and messy.

The tables carry no sales events of their own; a line item is read as one event, with the
part type as category and the supplier's region as store region.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..schemas import MONEY, PRICE

CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


# Columns of the test tables that are used. A stated schema saves the job that infers one.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_orderdate timestamp_ntz",
    "part": "p_partkey bigint, p_type string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    # No join hints: the optimizer broadcasts a table only while its own file size is below the
    # threshold (a pre-joined side would be estimated as a product and shuffled), and AQE splits a
    # hot join key.
    t = {name: _table(spark, sf_dir, name) for name in TABLES}
    return (t["lineitem"].join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
            .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
            .join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
            .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
            .join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")))


def _hundredths(column: str) -> Column:
    return F.floor(F.col(column) * 100 + 0.5)


def _money(cents: Column, as_type: DecimalType) -> Column:
    return (cents.cast(f"decimal({as_type.precision},0)") * F.lit("0.01").cast("decimal(2,2)")).cast(as_type)


def _columns() -> dict:
    # Money is computed in whole cents and rounded half up, so that results are exact and do not
    # depend on the engine.
    cents, percent, units = _hundredths("l_extendedprice"), _hundredths("l_discount"), F.col("l_quantity").cast("bigint")
    return {
        "id": ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")).cast("bigint"),
        "event_date": F.col("l_shipdate").cast("date"),
        "product_category": F.col("p_type"),
        "store_region": F.col("r_name"),
        "units_sold": units.cast("int"),
        "revenue": _money(F.floor((cents * (100 - percent) + 50) / 100), MONEY),
        "avg_unit_price": _money(F.floor((2 * cents + units) / (2 * units)), PRICE),
        "promotion_flag": F.col("l_discount") >= 0.05,
        "ingested_at": F.col("o_orderdate"),
    }


def sales_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One clean event per line item; natural keys repeat, ``id`` within a key does not."""
    return _joined(spark, sf_dir).select(*[c.alias(n) for n, c in _columns().items()])


def messy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as an untyped source would send them, with faults in some rows.

    Faults depend on tax and discount only: unreadable dates, padded or missing names, negative
    or missing numbers and flags.
    """
    c = _columns()
    tax, discount = F.col("l_tax"), F.col("l_discount")
    null = F.lit(None)
    c["event_date"] = F.when((tax == 0.06) & (discount == 0.07), F.lit("not a date")) \
        .otherwise(c["event_date"].cast("string"))
    c["product_category"] = F.when((tax == 0.0) & (discount == 0.0), null) \
        .when(F.col("l_returnflag") == "A", F.concat(F.lit(" "), F.col("p_type"), F.lit("  "))) \
        .otherwise(F.col("p_type"))
    c["store_region"] = F.when((tax == 0.03) & (discount == 0.1), null) \
        .when(F.col("l_linestatus") == "F", F.concat(F.col("r_name"), F.lit(" "))).otherwise(F.col("r_name"))
    c["units_sold"] = F.when((tax == 0.02) & (discount == 0.01), null) \
        .when((tax == 0.01) & (discount == 0.02), -c["units_sold"]).otherwise(c["units_sold"])
    c["revenue"] = F.when((tax == 0.05) & (discount == 0.08), -c["revenue"]).otherwise(c["revenue"])
    c["avg_unit_price"] = F.when((tax == 0.04) & (discount == 0.09), null).otherwise(c["avg_unit_price"])
    c["promotion_flag"] = F.when(discount == 0.0, null).otherwise(c["promotion_flag"])
    return _joined(spark, sf_dir).select(*[col.alias(n) for n, col in c.items()])
