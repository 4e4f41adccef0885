"""Event messages: one flat JSON object per sales event, sent in slices of a stored order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import CORRUPT, MESSAGE, REQUIRED_FIELDS
from ..session import scratch_path
from .lake import append_batch, table_exists

MESSAGE_FIELDS = tuple(f.name for f in MESSAGE.fields if f.name != CORRUPT)
PASS_THROUGH = ("ingested_at", "id")
MESSAGE_BLOCK = 8 << 20  # bytes of a row group: the unit in which the tasks of a micro-batch share a file
_SLOT_BITS = 33  # monotonically_increasing_id: partition number above, row number within it below


def to_messages(events: DataFrame) -> DataFrame:
    """Events as ``key``, ``value``: the natural key and the event, both as JSON, so that no two keys share a text.

    Columns of the source beyond the message (such as the arrival time) are kept next to it.
    """
    source = events.withColumnRenamed("event_date", "date") if "date" not in events.columns else events
    key = F.to_json(F.struct(F.col("date").cast("string").alias("date"), "product_category", "store_region"))
    body = F.struct(F.col("date").cast("string").alias("date"),
                    *[F.col(c) for c in MESSAGE_FIELDS if c != "date"])
    extra = [c for c in PASS_THROUGH if c in source.columns]
    return source.select(key.alias("key"), F.to_json(body).alias("value"), *extra)


def index_positions(events: DataFrame, order: Sequence[str | Column], path: str) -> None:
    """Store the history once in ``order``: a folder per range of positions, and a sparse index of the ranges.

    The sort is by range partitions, so no task sees more than its own range; the index has one row per range
    (``_range``, ``first`` position, ``rows``). A history that is indexed already is left as it is.
    """
    spark = events.sparkSession
    if table_exists(spark, f"{path}/index"):
        return
    sorted_rows = (events.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_slot", F.monotonically_increasing_id())
                   .withColumns({"_range": F.shiftright("_slot", _SLOT_BITS), "_slot": F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))}))
    sorted_rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_range").parquet(f"{path}/rows")
    sizes = spark.read.parquet(f"{path}/rows").groupBy(F.col("_range").cast("bigint").alias("_range")).agg(F.count("*").alias("rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    first = F.coalesce(F.sum("rows").over(before), F.lit(0)) + 1
    sizes.withColumn("first", first).coalesce(1).write.mode("overwrite").parquet(f"{path}/index")


def read_slice(spark: SparkSession, path: str, offset: int, limit: int | None = None) -> DataFrame:
    """Rows at the positions ``offset + 1`` .. ``offset + limit`` of an indexed history, with their ``position``.

    Ranges ascend with their positions, so a slice is a span of range folders; no other is opened.
    """
    index = spark.read.parquet(f"{path}/index")
    last = F.col("first") + F.col("rows") - 1
    wanted = last > offset if limit is None else (last > offset) & (F.col("first") <= offset + limit)
    ranges = index.filter(wanted).select("_range", "first")
    low, high = ranges.agg(F.min("_range"), F.max("_range")).first()
    rows = spark.read.parquet(f"{path}/rows").withColumn("_range", F.col("_range").cast("bigint")).filter(F.col("_range").between(F.lit(low), F.lit(high)))
    placed = rows.join(ranges, "_range").withColumn("position", F.col("first") + F.col("_slot"))
    inside = F.col("position") > offset if limit is None else F.col("position").between(offset + 1, offset + limit)
    return placed.filter(inside).drop("_range", "_slot", "first")


def publish_slice(events: DataFrame, order: Sequence[str | Column], offset: int, limit: int | None = None, path: str | None = None) -> DataFrame:
    """Rows ``offset + 1`` .. ``offset + limit`` of the history in ``order``, as messages.

    The order is stored under ``path`` (by default a folder of its own) and reused by later slices.
    """
    path = path or scratch_path(events.sparkSession, "positions")
    index_positions(events, order, path)
    return to_messages(read_slice(events.sparkSession, path, offset, limit).drop("position"))


def committed_offset(spark: SparkSession, offsets: str, topic: str) -> tuple[int, int]:
    """The number of rows sent to ``topic`` by the latest commit, and the number of commits."""
    if not table_exists(spark, offsets):
        return 0, 0
    stored = spark.read.parquet(offsets).filter(F.col("topic") == topic).agg(F.max_by("until", "version"), F.max("version")).first()
    return (stored[0], stored[1]) if stored[1] else (0, 0)


def commit_offset(spark: SparkSession, offsets: str, topic: str, start: int, until: int) -> None:
    """Record that the rows up to ``until`` have been sent."""
    version = committed_offset(spark, offsets, topic)[1] + 1
    row = spark.range(1).select(F.lit(topic).alias("topic"), F.lit(version).cast("bigint").alias("version"), F.lit(start).cast("bigint").alias("start"),
                                F.lit(until).cast("bigint").alias("until"), F.current_timestamp().alias("committed_at"))
    row.coalesce(1).write.mode("append").parquet(offsets)


def publish_next(spark: SparkSession, history: str, offsets: str, topic: str, limit: int | None = None, kafka: dict[str, str] | None = None,
                 restart: bool = False) -> tuple[int, int]:
    """Send the next ``limit`` rows of an indexed history to ``topic`` and commit the new offset; returns both offsets.

    ``topic`` is a folder of messages, or a Kafka topic with ``kafka`` options. The offset is committed after the
    messages are written: a run that stops in between is repeated by the next one, in the same batch of a folder, which it
    replaces, or once more to Kafka. ``restart`` goes back to the first row. One publisher per topic is assumed.
    """
    start, version = committed_offset(spark, offsets, topic)
    start = 0 if restart else start
    total = spark.read.parquet(f"{history}/index").agg(F.max(F.col("first") + F.col("rows") - 1)).first()[0] or 0
    until = total if limit is None else min(total, start + limit)
    if until > start:
        send_slice(spark, history, topic, start, until, version + 1, kafka)
        commit_offset(spark, offsets, topic, start, until)
    return start, until


def send_slice(spark: SparkSession, history: str, topic: str, start: int, until: int, version: int, kafka: dict[str, str] | None = None) -> None:
    """Write the rows ``start + 1`` .. ``until`` of an indexed history; in a folder they are the batch of this ``version``."""
    sent = to_messages(read_slice(spark, history, start, until - start).drop("position"))
    if kafka:
        write_messages(sent, kafka={**kafka, "topic": topic})
    else:
        append_batch(sent, topic, f"{version:06d}-{start}")


def parse_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON messages as typed columns; ``is_bad`` marks messages that do not fit the schema or lack a required field.

    A missing promotion flag is false. A bad message keeps its text in ``_corrupt_record`` and null event columns, and does not
    stop the batch or the stream.
    """
    parsed = messages.withColumn("_event", F.from_json(
        F.col(value).cast("string"), MESSAGE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    date = F.col("_event.date").try_cast("date")
    is_bad = F.col("_event").isNull() | F.col(f"_event.{CORRUPT}").isNotNull() | date.isNull()
    for field in REQUIRED_FIELDS:
        is_bad = is_bad | F.col(f"_event.{field}").isNull()
    fields = {c: F.col(f"_event.{c}") for c in MESSAGE_FIELDS if c != "date"}
    fields["promotion_flag"] = F.coalesce(fields["promotion_flag"], F.lit(False))
    good = [F.when(~F.col("is_bad"), date).alias("event_date")]
    good += [F.when(~F.col("is_bad"), column).alias(c) for c, column in fields.items()]
    extra = [c for c in PASS_THROUGH if c in messages.columns]
    return (parsed.withColumn("is_bad", is_bad)
            .select(*good, *extra, "is_bad", F.when(F.col("is_bad"), F.col(value).cast("string")).alias(CORRUPT)))


def write_messages(messages: DataFrame, path: str | None = None, kafka: dict[str, str] | None = None) -> None:
    """Send messages to a Kafka topic (``kafka`` options) or append them to a folder of Parquet message files."""
    if kafka:
        messages.select("key", "value").write.format("kafka").options(**kafka).save()
    elif path:
        messages.write.mode("append").option("parquet.block.size", MESSAGE_BLOCK).parquet(path)
    else:
        raise ValueError("give a path or Kafka options")


def read_event_stream(spark: SparkSession, path: str | None = None, kafka: dict[str, str] | None = None,
                      max_per_batch: int | None = None, schema: str = "key string, value string") -> DataFrame:
    """The message stream from its earliest offset: a Kafka topic or a folder of Parquet message files."""
    if kafka:
        reader = spark.readStream.format("kafka").option("startingOffsets", "earliest").options(**kafka)
        if max_per_batch:
            reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
        return reader.load()
    if not path:
        raise ValueError("give a path or Kafka options")
    reader = spark.readStream.schema(schema)
    if max_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_per_batch)
    return reader.parquet(path)
