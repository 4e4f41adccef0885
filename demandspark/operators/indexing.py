"""Positions in a global order without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_SLOT_BITS = 33  # monotonically_increasing_id: partition number above, row number within it below


def with_row_index(df: DataFrame, order: Sequence[str | Column], name: str = "row_index") -> DataFrame:
    """Add the position (1, 2, ...) of each row in ``order``.

    Range partitions are sorted on their own and written once with their partition and slot
    number; the start of each partition is the running sum of the partition sizes, a frame
    with one row per partition, so its window and broadcast stay small however large ``df`` is.
    """
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_slot", F.monotonically_increasing_id()))
    stored = materialize(placed, "row-index")
    part = F.shiftright("_slot", _SLOT_BITS)
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
              .select("_part", F.coalesce(F.sum("_rows").over(running), F.lit(0)).alias("_start")))
    within = F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    return (stored.withColumn("_part", part).join(F.broadcast(starts), "_part")
            .withColumn(name, (F.col("_start") + within + 1).cast("bigint"))
            .select(*df.columns, name))
