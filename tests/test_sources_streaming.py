import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from demandspark import session
from demandspark.operators import rollups, upsert
from demandspark.operators.dedupe import dedupe_latest, keep_first
from demandspark.plans.queries import QUERIES, _published
from demandspark.sources import files, jdbc, messages
from demandspark.sources.sample import sales_events
from demandspark.streaming import ingest, ingest_stats, ingest_stream, read_log, rollup_stream, run_available
from tests.conftest import SMALL, rows_of

SENT = "key string, value string, ingested_at timestamp_ntz, id bigint"


def test_csv_values_that_fit_a_pattern_but_no_type(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("i,d,t,b\n99999999999999999999,2024-99-99,2024-01-01 25:00:00,9223372036854775807\n1,2024-01-01,2024-01-01 10:00:00,1\n")
    frame = files.read_csv_inferred(spark, str(path))
    assert dict(frame.dtypes) == {"i": "double", "d": "string", "t": "string", "b": "bigint"}
    assert frame.filter("i is null or d is null or t is null or b is null").isEmpty()


def test_csv_types(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("i,r,d,t,s,e\n1,1.5,2023-01-01,2023-01-01 10:00,a,\n-2,1e3,2023-02-01,2023-01-02T10:00:30,1,\n,,,,,\n")
    frame = files.read_csv_inferred(spark, str(path))
    assert dict(frame.dtypes) == {"i": "bigint", "r": "double", "d": "date", "t": "timestamp_ntz", "s": "string", "e": "string"}
    assert frame.first().t == datetime(2023, 1, 1, 10)


def test_history_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "h")
    rows = [(date(2023, 1, 1), "Toys", 3, 9.5, 3.17, "North", True)]
    files.write_csv(spark.createDataFrame(rows, files.HISTORY_CSV), path, ["date"])
    assert [tuple(r) for r in files.read_history_csv(spark, path).collect()] == rows


def test_mart_scan_reads_only_its_columns(spark, tmp_path):
    path = str(tmp_path / "f")
    spark.range(10).selectExpr("date'2023-01-01' ds", "'A' product_category", "id y", "'m' other", "'p' model_name") \
        .write.partitionBy("model_name").parquet(path)
    scan = files.read_mart(spark, path, ["ds", "y"], model="p")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ds:date,y:bigint>" in plan and "PartitionFilters: [isnotnull(model_name" in plan


def test_jdbc_options():
    assert jdbc.read_options("t")["dbtable"] == "t"
    options = jdbc.read_options("t", jdbc.Split("id", 1, 100, 8))
    assert (options["partitionColumn"], options["numPartitions"], options["upperBound"]) == ("id", "8", "100")


def test_bad_messages_are_set_apart(spark):
    full = '{"date":"2023-01-01","product_category":"A","store_region":"N","units_sold":3,"revenue":1.5,"avg_unit_price":0.5}'
    lacking = [full.replace(field, "") for field in ('"product_category":"A",', '"store_region":"N",', '"units_sold":3,', '"revenue":1.5,')]
    bad = ['{"units_sold": "x"}', "not json", '{"date":"bad"}', full.replace("3", "null"), *lacking]
    parsed = messages.parse_events(spark.createDataFrame([(full,), *[(b,) for b in bad]], "value string"))
    assert sorted(r[0] for r in parsed.filter("is_bad").select("_corrupt_record").collect()) == sorted(bad)
    good = parsed.filter("not is_bad").first()
    assert (good.event_date, good.units_sold, good.promotion_flag, good._corrupt_record) == (date(2023, 1, 1), 3, False, None)


def test_message_keys_differ_where_events_do(spark):
    rows = [("2023-01-01", "a|b", "c"), ("2023-01-01", "a", "b|c"), ("2023-01-01", None, "x"), ("2023-01-01", "x", None)]
    ev = spark.createDataFrame([(d, c, r, 1, 1.0, 1.0, True) for d, c, r in rows],
                               "date string, product_category string, store_region string, units_sold int, revenue double, avg_unit_price double, promotion_flag boolean")
    assert messages.to_messages(ev).select("key").distinct().count() == 4


def test_publish_resumes_at_the_offset(events):
    ev = events(*[(i, 1 + i % 28, "A", "N", i, 1) for i in range(100)])
    order = ["event_date", "id"]
    parts = [messages.publish_slice(ev, order, start, 40) for start in (0, 40, 80)]
    assert [p.count() for p in parts] == [40, 40, 20]
    ids = [r.id for p in parts for r in p.collect()]
    assert sorted(ids) == list(range(100))
    assert messages.publish_slice(ev, order, 90).count() == 10
    assert messages.publish_slice(ev, order, 100).isEmpty()


def some_history(events, n=100):
    return events(*[(i, 1 + i % 28, "A", "N", i, 1) for i in range(n)])


def test_a_slice_opens_only_its_ranges(spark, events, tmp_path):
    path = str(tmp_path / "positions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        messages.index_positions(some_history(events, 400), ["id"], path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    index = spark.read.parquet(f"{path}/index").orderBy("first").collect()
    assert len(index) > 3 and [r.first for r in index] == [1 + sum(x.rows for x in index[:k]) for k in range(len(index))]
    middle = index[2]
    for r in index[1:]:  # the other ranges cannot be read any more; the first one tells the columns
        if r._range != middle._range:
            for file in (tmp_path / "positions" / "rows" / f"_range={r._range}").glob("*.parquet"):
                file.write_bytes(b"not parquet")
                (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    got = messages.read_slice(spark, path, middle.first - 1 + 2, middle.rows - 4)
    assert [r.id for r in got.orderBy("position").collect()] == list(range(middle.first + 1, middle.first + middle.rows - 3))
    with pytest.raises(Exception, match="(?i)parquet"):
        messages.read_slice(spark, path, index[1].first, 1).collect()


def test_publishing_resumes_at_the_committed_offset(spark, events, tmp_path, monkeypatch):
    history, offsets, topic = (str(tmp_path / n) for n in ("positions", "offsets", "topic"))
    messages.index_positions(some_history(events), ["id"], history)
    sent = lambda: sorted(r.id for r in spark.read.parquet(topic).collect())
    assert messages.publish_next(spark, history, offsets, topic, 30) == (0, 30)

    def stop(*args):
        raise RuntimeError("stopped")
    with monkeypatch.context() as patched:
        patched.setattr(messages, "commit_offset", stop)
        with pytest.raises(RuntimeError):
            messages.publish_next(spark, history, offsets, topic, 30)
    assert messages.publish_next(spark, history, offsets, topic, 20) == (30, 50)
    assert sent() == list(range(50))  # what the stopped run sent was replaced
    assert messages.publish_next(spark, history, offsets, topic) == (50, 100)
    assert messages.publish_next(spark, history, offsets, topic) == (100, 100)
    assert messages.publish_next(spark, history, offsets, topic, 10, restart=True) == (0, 10)
    assert messages.committed_offset(spark, offsets, topic) == (10, 4)
    assert sent() == sorted([*range(100), *range(10)])
    assert messages.committed_offset(spark, offsets, "other") == (0, 0)


def test_shared_folder(spark):
    folder = session.shared_dir(spark)
    assert folder == session.shared_dir(spark)
    df = spark.range(5).selectExpr("id", "timestamp_ntz'2023-01-01 00:00:00' t")
    assert session.materialize(df).schema["t"].dataType == df.schema["t"].dataType
    with session.staged(df) as copy:
        files_written = [f.removeprefix("file:") for f in copy.inputFiles()]
        assert copy.count() == 5
    assert files_written and not any(os.path.exists(f.replace("///", "/")) for f in files_written)


def source(spark, path, **options):
    return messages.read_event_stream(spark, path, schema=SENT, **options)


def test_ingest_drains_resumes_and_survives_replay(spark, events, tmp_path):
    path, table, bad = (str(tmp_path / n) for n in ("in", "table", "bad"))
    first = events((1, 1, "A", "N", 5, 1), (2, 1, "A", "N", 7, 2), (3, 2, "A", "N", 1, 1))
    messages.write_messages(messages.to_messages(first), path)
    checkpoint = str(tmp_path / "c1")
    run_available(ingest_stream(source(spark, path), table, checkpoint, bad))
    assert rows_of(spark.read.parquet(table), "id") == [(1,), (3,)]

    broken = spark.createDataFrame([("k", '{"units_sold": "x"}', None, None)], SENT)
    later = messages.to_messages(events((4, 1, "A", "N", 9, 9), (5, 3, "B", "N", 2, 9))).unionByName(broken)
    messages.write_messages(later, path)
    query = run_available(ingest_stream(source(spark, path), table, checkpoint, bad))
    assert sum(p["numInputRows"] for p in query.recentProgress) == 3
    assert rows_of(spark.read.parquet(table), "id") == [(1,), (3,), (5,)]
    assert spark.read.parquet(bad).count() == 1

    run_available(ingest_stream(source(spark, path), table, str(tmp_path / "c2"), bad))
    assert rows_of(spark.read.parquet(table), "id") == [(1,), (3,), (5,)]


def test_watermark_option(spark, events, tmp_path):
    path, table = str(tmp_path / "in"), str(tmp_path / "table")
    ev = events((1, 1, "A", "N", 5, 1), (2, 1, "A", "N", 7, 1), (3, 2, "A", "N", 1, 1))
    messages.write_messages(messages.to_messages(ev), path)
    stream = source(spark, path).withColumn("timestamp", F.col("ingested_at").cast("timestamp"))
    run_available(ingest_stream(stream, table, str(tmp_path / "c"), dedupe="watermark"))
    assert spark.read.parquet(table).count() == 2
    with pytest.raises(ValueError):
        ingest_stream(stream, table, "c", dedupe="never")


def test_stream_equals_batch_for_any_batch_size(spark, tmp_path):
    ev = sales_events(spark, SMALL)
    path = str(tmp_path / "in")
    messages.write_messages(messages.to_messages(ev).repartition(6), path)
    silver, view = str(tmp_path / "silver"), str(tmp_path / "view")
    query = run_available(rollup_stream(source(spark, path, max_per_batch=2), silver, view, str(tmp_path / "c")))
    assert sum(p["numInputRows"] for p in query.recentProgress) == ev.count()
    expected = rollups.rollups(dedupe_latest(ev))
    assert upsert.snapshot_diff(expected, spark.read.parquet(f"{view}/gold").select(*expected.columns)).isEmpty()


def send(spark, events, path, *rows):
    messages.write_messages(messages.to_messages(events(*rows)).coalesce(1), path)


def test_counts_of_runs(spark, events, tmp_path):
    path, table, bad, log = (str(tmp_path / n) for n in ("in", "table", "bad", "log"))
    send(spark, events, path, (1, 1, "A", "N", 5, 1), (2, 1, "A", "N", 7, 2), (3, 2, "A", "N", 1, 1))
    spark.createDataFrame([("k", "not json", None, None)], SENT).coalesce(1).write.mode("append").parquet(path)
    for checkpoint in ("c1", "c1", "c2"):  # the second run of c1 has nothing to read
        run_available(ingest_stream(source(spark, path), table, str(tmp_path / checkpoint), bad, log=log))
    got = {(r.consumed, r.written, r.skipped, r.quarantined, r.late) for r in ingest_stats(read_log(spark, log)).collect()}
    assert got == {(4, 2, 1, 1, 0), (4, 0, 3, 1, 0)}


def test_late_events_are_kept_apart(spark, events, tmp_path):
    path, table, log, late, checkpoint = (str(tmp_path / n) for n in ("in", "table", "log", "late", "c"))
    deliveries = [[(1, 20, "A", "N", 5, 1), (2, 2, "A", "N", 1, 1)], [(3, 21, "A", "N", 5, 2), (4, 9, "A", "N", 5, 2), (5, 10, "A", "N", 5, 2)],
                  [(6, 11, "B", "N", 5, 3), (7, 10, "B", "N", 5, 3), (8, 20, "A", "N", 5, 3)]]
    for rows in deliveries:
        send(spark, events, path, *rows)
        run_available(ingest_stream(source(spark, path), table, checkpoint, log=log, late=late, lateness_days=10))
    assert rows_of(spark.read.parquet(table), "id") == [(1,), (2,), (3,), (5,), (6,)]
    assert rows_of(spark.read.parquet(late), "id") == [(4,), (7,)]
    total = ingest_stats(read_log(spark, log)).first()
    assert (total.consumed, total.written, total.skipped, total.late) == (8, 5, 1, 2)
    # A replay meets the same watermarks, stores nothing and keeps late events once.
    run_available(ingest_stream(source(spark, path, max_per_batch=1), table, str(tmp_path / "c2"), log=log, late=late, lateness_days=10))
    assert spark.read.parquet(table).count() == 5 and spark.read.parquet(late).count() == 2


def test_runs_end_at_their_cap(spark, events, tmp_path):
    path, table, log, backlog, checkpoint = (str(tmp_path / n) for n in ("in", "table", "log", "backlog", "c"))
    for start in (0, 10, 20):
        send(spark, events, path, *[(k, 1 + k % 28, "A" if k < 28 else "B", "N", k, 1) for k in range(start, start + 10)])

    def run(cap):
        query = ingest_stream(source(spark, path, max_per_batch=1), table, checkpoint, log=log, max_messages=cap, backlog=backlog)
        run_available(query)
        return sorted(r.id for r in spark.read.parquet(table).collect())
    assert run(10) == list(range(10))        # exactly a file: the next one stays uncommitted
    assert run(3) == list(range(13))         # cut within a file
    assert run(2) == list(range(15))         # only from what was put off
    assert run(7) == list(range(22))         # the rest of it, then a part of the last file
    assert run(None) == list(range(30))      # everything else
    assert run(5) == list(range(30))
    log_rows = read_log(spark, log)
    assert ingest_stats(log_rows).first().consumed == 30 and log_rows.filter("part > 0").count() == 3
    with pytest.raises(ValueError, match="log"):
        ingest_stream(source(spark, path), table, checkpoint, max_messages=3)


def test_a_capped_batch_that_is_delivered_again_is_cut_alike(spark, events, tmp_path, monkeypatch):
    path, table, log, backlog, checkpoint = (str(tmp_path / n) for n in ("in", "table", "log", "backlog", "c"))
    send(spark, events, path, *[(k, 1 + k % 28, "A", "N", k, 1) for k in range(20)])
    original = ingest._Sink.batch

    def stopped(self, batch, number, admission):
        original(self, batch, number, admission)
        raise RuntimeError("stopped before the commit")
    with monkeypatch.context() as patched:
        patched.setattr(ingest._Sink, "batch", stopped)
        with pytest.raises(Exception, match="stopped"):
            run_available(ingest_stream(source(spark, path), table, checkpoint, log=log, max_messages=6, backlog=backlog))
    run_available(ingest_stream(source(spark, path), table, checkpoint, log=log, max_messages=9, backlog=backlog))
    assert sorted(r.id for r in spark.read.parquet(table).collect()) == list(range(15))
    assert ingest_stats(read_log(spark, log)).first().consumed == 15


def test_insert_ignore_keeps_the_first(events):
    ev = events((1, 1, "A", "N", 5, 3), (2, 1, "A", "N", 7, 2))
    assert keep_first(ev).first().id == 2


def test_bad_messages_without_quarantine_fail(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([("k", "not json")], "key string, value string").write.parquet(path)
    stream = spark.readStream.schema("key string, value string").parquet(path)
    with pytest.raises(Exception, match="quarantine"):
        run_available(ingest_stream(stream, str(tmp_path / "table"), str(tmp_path / "checkpoint")))


@pytest.mark.parametrize("pick, kept", [(keep_first, 1), (dedupe_latest, 2)])
def test_a_batch_is_stored_by_key(spark, events, pick, kept):
    """Repeated events are stored as one row, bad messages each on its own; counts are of all messages."""
    sent = messages.to_messages(events((1, 9, "A", "N", 5, 1), (2, 9, "A", "N", 7, 2), (3, 2, "A", "N", 1, 1), (5, 12, "B", "N", 2, 1)))
    broken = spark.createDataFrame([("k", "not json", None, None)] * 2 + [("k", None, None, None)], SENT)
    with ingest._observed(ingest._events(sent.unionByName(broken)), pick=pick) as (stored, counts):
        assert counts == {"consumed": 7, "quarantined": 3, "late": 0, "latest": date(2023, 1, 12)}
        assert rows_of(stored.filter("not is_bad"), "id") == [(kept,), (3,), (5,)]
        assert rows_of(stored.filter("is_bad and _corrupt_record is not null"), "_corrupt_record") == [("not json",)] * 2
        assert stored.filter("is_bad").count() == 3


def test_a_year_of_messages_is_one_entry(spark):
    """Files of small shuffle partitions would make as many micro-batches as there are partitions."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    with session.setting(spark, key, "16k"):
        path = _published(spark, SMALL, True)
        assert spark.conf.get(key) == "16k"
    sent = spark.read.parquet(path).withColumn("file", F.input_file_name())
    assert sent.groupBy(F.year("ingested_at")).agg(F.count_distinct("file").alias("n")).filter("n > 1").isEmpty()


def test_tasks_can_share_a_message_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(messages, "MESSAGE_BLOCK", 64 << 10)
    path = str(tmp_path / "in")
    sent = spark.range(40_000).select(F.lit("k").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("value"))
    messages.write_messages(sent.coalesce(1), path)
    with session.setting(spark, "spark.sql.files.maxPartitionBytes", "256k"), session.setting(spark, "spark.sql.files.openCostInBytes", "1"):
        per_task = spark.read.parquet(path).groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 1


def test_an_empty_delivery_counts_nothing(spark, events, tmp_path):
    path, table, log, late = (str(tmp_path / n) for n in ("in", "table", "log", "late"))
    send(spark, events, path, (1, 1, "A", "N", 5, 1))
    spark.createDataFrame([], SENT).coalesce(1).write.mode("append").parquet(path)
    run_available(ingest_stream(source(spark, path, max_per_batch=1), table, str(tmp_path / "c"), log=log, late=late))
    total = ingest_stats(read_log(spark, log)).first()
    assert (total.consumed, total.written, total.skipped, total.late) == (1, 1, 0, 0)
    run_available(rollup_stream(source(spark, path, max_per_batch=1), str(tmp_path / "silver"), str(tmp_path / "view"), str(tmp_path / "r")))
    assert spark.read.parquet(str(tmp_path / "view" / "gold")).count() == 1


def test_deliveries_share_one_join(spark, monkeypatch):
    """The tables are joined once, not for every delivery."""
    read, to_messages = [], messages.to_messages
    monkeypatch.setattr(messages, "to_messages", lambda rows: read.extend(rows.inputFiles()) or to_messages(rows))
    assert QUERIES["stream_late"](spark, SMALL).count()
    assert read and not any(SMALL in file for file in read)
