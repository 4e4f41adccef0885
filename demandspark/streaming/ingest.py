"""Structured Streaming: message ingest with counts, late events and caps, and rollups kept current.

All sinks are ``foreachBatch`` writers whose effect does not depend on how often a batch is delivered: an
interrupted batch is run again by Spark under the same batch number and replaces its own output, and a message sent
twice is recognised by its natural key in the table. Exact deduplication therefore needs no streaming state.

What a batch did is one row of the ingest log (``log``): messages consumed, written, skipped, quarantined, late and put
off, and the latest event date seen. The log drives the rest: the watermark that decides what is late, and what a capped run
still has to take.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.dedupe import dedupe_first, dedupe_latest
from ..operators.indexing import with_row_index
from ..operators.upsert import MONTH, months_in
from ..schemas import CORRUPT, EVENT_KEY, EVENTS
from ..session import staged
from ..sources.lake import append_batch, table_exists
from ..sources.messages import parse_events
from .views import merge_and_refresh

LOG = ("run string, number bigint, part bigint, consumed bigint, written bigint, skipped bigint, quarantined bigint, late bigint, put_off bigint, "
       "latest date, recorded_at timestamp")
COUNTS = ("consumed", "written", "skipped", "quarantined", "late")
_ORDER = ("ingested_at", "id", *EVENT_KEY, "units_sold", "revenue", "avg_unit_price", "promotion_flag", CORRUPT)


def _events(messages: DataFrame) -> DataFrame:
    """Parsed messages with arrival time and id: those of the source, else the time of the batch
    and a hash of the event."""
    parsed = parse_events(messages)
    if "ingested_at" not in parsed.columns:
        arrival = F.col("timestamp") if "timestamp" in messages.columns else F.current_timestamp()
        parsed = parse_events(messages.withColumn("ingested_at", arrival.cast("timestamp_ntz")))
    if "id" not in parsed.columns:
        parsed = parsed.withColumn("id", F.xxhash64(*EVENT_KEY, "units_sold", "revenue", "avg_unit_price"))
    return parsed.select(*EVENTS.names, "is_bad", CORRUPT)


def _per_key(parsed: DataFrame, pick: Callable[..., DataFrame]) -> DataFrame:
    """Of the good events the one of each natural key that ``pick`` takes; bad messages row by row."""
    alone = F.when(F.col("is_bad"), F.monotonically_increasing_id())
    return pick(parsed.withColumn("_alone", alone), [*EVENT_KEY, CORRUPT, "_alone"]).select(*parsed.columns)


@contextmanager
def _observed(parsed: DataFrame, mark: date | None = None, pick: Callable[..., DataFrame] | None = None) -> Iterator[tuple[DataFrame, dict]]:
    """Parsed messages stored for the length of the block, with counts of all of them taken on the way; events before ``mark`` are late.

    With ``pick`` the stored rows are those of ``_per_key``: messages are parsed and brought together by key in one pass, so
    what is stored follows the number of keys rather than of messages. Bad messages and late events are all kept; callers
    that expect many of them give no ``pick``, so that these need no shuffle.
    """
    seen = Observation()
    late = F.count_if(F.col("event_date") < F.lit(mark)) if mark else F.lit(0).cast("bigint") * F.count(F.lit(1))
    counts = (F.count(F.lit(1)).alias("consumed"), F.count_if("is_bad").alias("quarantined"), late.alias("late"), F.max("event_date").alias("latest"))
    counted = parsed.observe(seen, *counts)
    with staged(_per_key(counted, pick) if pick else counted, "parsed") as stored:
        # An empty batch leaves no metrics behind: adaptive execution takes its plan away.
        none = {**dict.fromkeys(("consumed", "quarantined", "late"), 0), "latest": None}
        yield stored, none if stored.isEmpty() else seen.get


def _quarantine(parsed: DataFrame, found: int, quarantine: str | None, name: str) -> DataFrame:
    """The good events; bad messages go to the quarantine folder, or fail the batch if there is none."""
    if found:
        if not quarantine:
            raise ValueError("malformed messages and no quarantine folder")
        append_batch(parsed.filter("is_bad").select(CORRUPT), quarantine, name)
    return parsed.filter(~F.col("is_bad")).select(*EVENTS.names)


def _stored_keys(spark: SparkSession, path: str, batch: DataFrame, name: str) -> DataFrame:
    """Keys already in the table, in the months the batch touches, from other batches."""
    months = months_in(batch)
    if not table_exists(spark, path):
        return batch.limit(0).select(*EVENT_KEY)
    table = spark.read.parquet(path)
    return table.filter(F.col(MONTH).isin(months) & (F.col("_batch_id").cast("string") != name)).select(*EVENT_KEY)


def _run_name(checkpoint: str) -> str:
    # A new checkpoint counts its batches from 0 again; the prefix keeps both runs apart.
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:8]


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """The ingest log; empty if there is none yet."""
    if not table_exists(spark, log):
        return spark.createDataFrame([], LOG)
    return spark.read.schema(LOG).parquet(log)


def ingest_stats(log: DataFrame) -> DataFrame:
    """Per run (checkpoint): messages consumed = written + skipped + quarantined + late."""
    return log.groupBy("run").agg(*[F.sum(c).alias(c) for c in COUNTS])


@dataclass
class _Admission:
    """How many messages a run may still take."""

    remaining: int | None
    closed: bool = False

    def take(self, wanted: int) -> int:
        if self.remaining is None:
            return wanted
        taken = min(wanted, self.remaining)
        self.remaining -= taken
        return taken


class _CapReached(Exception):
    """Ends a run before its next batch, which stays uncommitted and is the first of the next run."""


@dataclass
class _Sink:
    """Where the events of a run go."""

    table: str
    run: str
    quarantine: str | None
    log: str | None
    late: str | None
    lateness_days: int
    backlog: str | None

    def watermark(self, spark: SparkSession, number: int) -> date | None:
        """The latest event date of earlier batches of the run, less the allowed lateness; none for the first batch."""
        if not self.late:
            return None
        earlier = read_log(spark, self.log).filter((F.col("run") == self.run) & (F.col("number") < number))
        return earlier.agg(F.date_sub(F.max("latest"), self.lateness_days)).first()[0]

    def set_late_apart(self, good: DataFrame, mark: date, name: str) -> None:
        """Late events go to the side table, each once."""
        behind, identity = good.filter(F.col("event_date") < F.lit(mark)), ["id", *EVENT_KEY]
        if table_exists(good.sparkSession, self.late):
            known = good.sparkSession.read.parquet(self.late).filter(F.col("_batch_id").cast("string") != name).select(*identity)
            behind = behind.join(known, identity, "left_anti")
        append_batch(behind, self.late, name)

    def store(self, parsed: DataFrame, counts: dict, mark: date | None, number: int, part: int, put_off: int) -> None:
        """Insert-ignore of one batch (``part`` 0) or of a part of what an earlier batch put off, and its row in the log."""
        spark, name = parsed.sparkSession, f"{self.run}-{number}" + (f"-{part}" if part else "")
        good = _quarantine(parsed, counts["quarantined"], self.quarantine, name)
        if counts["late"]:
            self.set_late_apart(good, mark, name)
            good = good.filter(F.col("event_date") >= F.lit(mark))
        events = good.withColumn(MONTH, F.trunc("event_date", "MM"))
        new = dedupe_first(events, _stored_keys(spark, self.table, events, name))
        append_batch(new, self.table, name, [MONTH])
        if self.log:
            written = spark.read.schema(EVENTS).parquet(f"{self.table}/_batch_id={name}").count()  # from the footers of its files
            skipped = counts["consumed"] - counts["quarantined"] - counts["late"] - written
            row = (self.run, number, part, counts["consumed"], written, skipped, counts["quarantined"], counts["late"], put_off, counts["latest"])
            columns = LOG.removesuffix(", recorded_at timestamp")
            append_batch(spark.createDataFrame([row], columns).withColumn("recorded_at", F.current_timestamp()), self.log, name)

    def batch(self, messages: DataFrame, number: int, admission: _Admission) -> None:
        """One micro-batch: as much of it as the run may still take; the rest is put off to the backlog."""
        if admission.remaining == 0:
            admission.closed = True
            raise _CapReached
        mark = self.watermark(messages.sparkSession, number)
        with _observed(_events(messages), mark) as (parsed, counts):
            taken = counts["consumed"]
            if admission.remaining is not None:
                mine = (F.col("run") == self.run) & (F.col("number") == number) & (F.col("part") == 0)
                before = read_log(messages.sparkSession, self.log).filter(mine).first()
                taken = admission.take(taken) if before is None else before.consumed  # delivered again: the same cut
            put_off = counts["consumed"] - taken
            if not put_off:
                self.store(parsed, counts, mark, number, 0, 0)
                return
            placed = with_row_index(parsed, list(_ORDER), "place")
            append_batch(placed.filter(F.col("place") > taken), self.backlog, f"{self.run}-{number}")
            self.take_part(placed.filter(F.col("place") <= taken), number, 0, put_off)

    def take_part(self, rows: DataFrame, number: int, part: int, put_off: int) -> None:
        mark = self.watermark(rows.sparkSession, number)
        with _observed(rows.select(*EVENTS.names, "is_bad", CORRUPT), mark) as (parsed, counts):
            self.store(parsed, counts, mark, number, part, put_off)

    def drain(self, spark: SparkSession, admission: _Admission) -> None:
        """First what earlier batches of the run put off, in their order, as far as the run may take."""
        log = read_log(spark, self.log).filter(F.col("run") == self.run)
        open_batches = (log.groupBy("number").agg(F.max("put_off").alias("put_off"), F.sum("consumed").alias("place"),
                                                  F.sum(F.when(F.col("part") > 0, F.col("consumed")).otherwise(0)).alias("done"))
                        .filter("done < put_off").orderBy("number").collect())  # batches cut by a cap: one a run
        for row in open_batches:
            taken = admission.take(row.put_off - row.done)
            if taken:
                held = spark.read.parquet(f"{self.backlog}/_batch_id={self.run}-{row.number}")
                self.take_part(held.filter(F.col("place").between(row.place + 1, row.place + taken)), row.number, row.place, 0)


def _start(stream: DataFrame, write_batch, checkpoint: str) -> StreamingQuery:
    # A micro-batch reaches the writer whole; the natural key is in the value once more.
    return (stream.drop("key").writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def ingest_stream(messages: DataFrame, table: str, checkpoint: str, quarantine: str | None = None,
                  dedupe: str = "table", watermark: str = "1 day", log: str | None = None, late: str | None = None,
                  lateness_days: int = 30, max_messages: int | None = None, backlog: str | None = None) -> StreamingQuery:
    """Insert-ignore ingest: new natural keys are appended, known ones skipped.

    The query reads what is available and stops; the checkpoint makes the next run resume, a new
    checkpoint replays from the start.

    * ``log``: a folder for one row of counts per batch (``ingest_stats`` sums them).
    * ``late``: a folder for events whose date lies more than ``lateness_days`` before the latest date of earlier batches;
      they are kept there instead of in the table. Needs ``log``. By default late events are accepted.
    * ``max_messages``: the run ends after exactly that many messages, bad and repeated ones included. What the last
      batch holds beyond is put off to ``backlog``, in order of arrival, and taken first by the next run. Needs ``log``.
    * ``dedupe="watermark"`` also drops repeats inside the watermark before the table is asked, which needs a ``timestamp``
      column; it drops events that arrive later than the watermark uncounted. Prefer ``late``.
    """
    if dedupe not in ("table", "watermark"):
        raise ValueError("dedupe must be 'table' or 'watermark'")
    if (late or max_messages is not None) and not log or max_messages is not None and not backlog:
        raise ValueError("late events and caps need a log, caps a backlog folder as well")
    if dedupe == "watermark":
        messages = messages.withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(["key"])
    sink = _Sink(table, _run_name(checkpoint), quarantine, log, late, lateness_days, backlog)
    admission = _Admission(max_messages)
    if backlog and log:
        sink.drain(messages.sparkSession, admission)
    query = _start(messages, lambda batch, number: sink.batch(batch, number, admission), checkpoint)
    query.admission = admission
    return query


def rollup_stream(messages: DataFrame, silver: str, view: str, checkpoint: str,
                  quarantine: str | None = None) -> StreamingQuery:
    """Latest-wins upsert of every batch into silver, then a refresh of the view on the days it changed.

    The rollups are in ``view``/gold, by month. A batch costs what it touches, however long the history is.
    """
    def write_batch(batch: DataFrame, number: int) -> None:
        name = f"{_run_name(checkpoint)}-{number}"
        with _observed(_events(batch), pick=None if quarantine else dedupe_latest) as (parsed, counts):
            events = _quarantine(parsed, counts["quarantined"], quarantine, name)
            merge_and_refresh(batch.sparkSession, silver, view, events, name, unique=not quarantine)

    return _start(messages, write_batch, checkpoint)


def run_available(query: StreamingQuery) -> StreamingQuery:
    """Wait until the query has read everything that was available or its cap is reached, and raise its error if any."""
    capped = getattr(query, "admission", None)
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if capped is None or not capped.closed:
            raise
    return query
