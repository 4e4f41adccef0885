"""Zone map of an append-only table: which stored batches may hold the rows of a source.

A zone is a month of arrival. For each batch and zone the map has the number of rows and the sum of their
identities' hashes. A zone of the source is

* new, if no batch has rows in it: its rows are unknown without a look at the table;
* known, if numbers and sums agree: none of its rows is unknown;
* open otherwise: only its rows are compared, and only with the batches that have rows in it.

The map has one row per batch and month, the comparison one per month, however many rows there are. Rows
without an arrival time are a zone of their own. Two sets of rows of equal size and equal 128-bit sum count as equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..sources.lake import append_batch, folder_values, table_exists

IDENTITY = ("id", "ingested_at")
NO_ARRIVAL = "none"
_ZONES = "zone string, rows bigint, hash_low decimal(38,0), hash_high decimal(38,0), _batch_id string"


def zone(arrival: str = "ingested_at") -> Column:
    return F.coalesce(F.date_format(arrival, "yyyy-MM"), F.lit(NO_ARRIVAL))


def zone_map(rows: DataFrame, identity: Sequence[str] = IDENTITY) -> DataFrame:
    """Per zone: rows and two sums of hashes of their identities."""
    arrival = identity[-1]
    hashes = [F.xxhash64(F.lit(salt), *identity).cast("decimal(38,0)") for salt in (0, 1)]
    return rows.groupBy(zone(arrival).alias("zone")).agg(F.count("*").alias("rows"), F.sum(hashes[0]).cast("decimal(38,0)").alias("hash_low"),
                                                         F.sum(hashes[1]).cast("decimal(38,0)").alias("hash_high"))


def stored_rows(spark: SparkSession, path: str, columns: StructType) -> DataFrame:
    """A table of batches with a stated type for their names: a batch id of digits would be read as a number."""
    return spark.read.schema(StructType([*columns.fields, StructField("_batch_id", StringType())])).parquet(path)


def complete_map(spark: SparkSession, table: str, zones: str, columns: StructType) -> None:
    """Add the batches that are stored without zones, such as one whose run stopped in between."""
    mapped = set(folder_values(spark, zones, "_batch_id"))
    for name in folder_values(spark, table, "_batch_id"):
        if name not in mapped:
            append_batch(zone_map(spark.read.schema(columns).parquet(f"{table}/_batch_id={name}")), zones, name)


def stored_batches(spark: SparkSession, zones: str) -> set[str]:
    """The names of the stored batches that have rows."""
    held = spark.read.schema(_ZONES).parquet(zones).filter("rows > 0")
    return {r[0] for r in held.select("_batch_id").distinct().collect()}  # one name per batch


def compare_zones(source: DataFrame, stored: DataFrame) -> DataFrame:
    """Per zone of ``source``: ``state`` new, known or open."""
    totals = stored.groupBy("zone").agg(*[F.sum(c).cast("decimal(38,0)").alias(f"stored_{c}") for c in ("rows", "hash_low", "hash_high")])
    same = (F.col("rows") == F.col("stored_rows")) & (F.col("hash_low") == F.col("stored_hash_low")) & (F.col("hash_high") == F.col("stored_hash_high"))
    state = F.when(F.col("stored_rows").isNull(), "new").when(same, "known").otherwise("open")
    return zone_map(source).join(totals, "zone", "left").select("zone", state.alias("state"))


def unknown_rows(source: DataFrame, table: str, zones: str, skip: str | None = None) -> tuple[DataFrame, list[str]]:
    """Rows of ``source`` whose identity is not stored in ``table``, and the names of the batches that are opened for it.

    ``skip`` names a batch that does not count as stored, because it is about to be written again.
    """
    spark = source.sparkSession
    if not table_exists(spark, table):
        return source, []
    complete_map(spark, table, zones, source.schema)
    stored = spark.read.schema(_ZONES).parquet(zones).filter(F.col("_batch_id") != F.lit(skip or ""))
    states = {r.zone: r.state for r in compare_zones(source, stored).collect()}  # one row per month of arrival
    new, mixed = ([z for z, s in states.items() if s == wanted] for wanted in ("new", "open"))
    fresh = source.filter(zone().isin(new)) if new else source.filter(F.lit(False))
    if not mixed:
        return fresh, []
    opened = sorted(r[0] for r in stored.filter(F.col("zone").isin(mixed)).select("_batch_id").distinct().collect())
    rows = stored_rows(spark, table, source.schema).filter(F.col("_batch_id").isin(opened) & zone().isin(mixed) & _arrived(mixed))
    known = rows.select(*[F.col(c).alias(f"_known_{c}") for c in IDENTITY])
    same = F.col("id").eqNullSafe(F.col("_known_id")) & F.col("ingested_at").eqNullSafe(F.col("_known_ingested_at"))
    return fresh.unionAll(source.filter(zone().isin(mixed)).join(known, same, "left_anti")), opened


def _arrived(zones: list[str]) -> Column:
    """A range of arrival times that holds the zones; it reaches the statistics of the files."""
    months = sorted(z for z in zones if z != NO_ARRIVAL)
    if not months:
        return F.col("ingested_at").isNull()
    after = F.add_months(F.to_date(F.lit(f"{months[-1]}-01")), 1).cast("timestamp_ntz")
    inside = (F.col("ingested_at") >= F.to_date(F.lit(f"{months[0]}-01")).cast("timestamp_ntz")) & (F.col("ingested_at") < after)
    return inside | F.col("ingested_at").isNull() if NO_ARRIVAL in zones else inside
