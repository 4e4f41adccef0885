import random

import pytest
from pyspark.sql import functions as F

from demandspark.operators import quality, rollups, upsert, zones
from demandspark.operators.dedupe import dedupe_latest
from demandspark.plans import stages
from demandspark.plans.queries import QUERIES
from demandspark.schemas import EVENT_KEY, EVENTS
from demandspark.sources import lake
from demandspark.sources.sample import sales_events
from tests.conftest import SMALL, rows_of


def same(a, b):
    return upsert.snapshot_diff(a, b.select(*a.columns)).isEmpty()


def test_upsert_equal_older_newer(events):
    target = events((5, 1, "A", "N", 1, 5))
    for row, changes in [((5, 1, "A", "N", 1, 5), (0, 0, 1)), ((4, 1, "A", "N", 9, 4), (0, 0, 1)),
                         ((6, 1, "A", "N", 9, 5), (0, 1, 0)), ((1, 1, "A", "N", 9, 6), (0, 1, 0)),
                         ((6, 2, "A", "N", 9, 5), (1, 0, 0))]:
        m = upsert.upsert_metrics(target, events(row)).first()
        assert (m.inserted, m.updated, m.unchanged) == changes, row
    merged = upsert.upsert_newer(target, events((6, 1, "A", "N", 9, 5), (7, 3, "A", "N", 2, 1)))
    assert rows_of(merged, "id") == [(6,), (7,)]


def test_upsert_twice_changes_nothing(events):
    batch = events((1, 1, "A", "N", 5, 1), (2, 1, "A", "N", 7, 2), (3, 2, "B", "N", 1, 1))
    once = upsert.upsert_newer(batch.limit(0), batch)
    m = upsert.upsert_metrics(once, batch).first()
    assert (m.source_rows, m.inserted, m.updated, m.unchanged) == (2, 0, 0, 2)


def test_snapshot_diff_keeps_multiplicity(events):
    a = events(*[(1, 1, "A", "N", 5, 1)] * 5, (2, 2, "A", "N", 1, 1))
    b = events(*[(1, 1, "A", "N", 5, 1)] * 2, (3, 3, "A", "N", 1, 1))
    got = rows_of(upsert.snapshot_diff(a, b, ["id"]), "id", "side", "copies")
    assert got == [(1, "left", 3), (2, "left", 1), (3, "right", 1)]


def test_merge_into_is_order_independent_and_idempotent(spark, tmp_path):
    ev = sales_events(spark, SMALL).withColumn("batch", F.year("ingested_at")).cache()
    years = [r[0] for r in ev.select("batch").distinct().orderBy("batch").collect()]
    shuffled = years[:]
    random.Random(7).shuffle(shuffled)
    path = str(tmp_path / "silver")
    for year in [*shuffled[:4], shuffled[0], *shuffled[4:]]:
        upsert.merge_into(spark, path, ev.filter(F.col("batch") == year).drop("batch"))
    table = spark.read.parquet(path)
    assert same(dedupe_latest(ev.drop("batch")), table)
    again = upsert.merge_into(spark, path, ev.filter(F.col("batch") == years[0]).drop("batch"))
    assert again["inserted"] == 0 and again["updated"] == 0
    assert same(dedupe_latest(ev.drop("batch")), spark.read.parquet(path))


def test_build_lake_twice_and_parity(spark, tmp_path):
    raw = sales_events(spark, SMALL).cache()
    root = str(tmp_path)
    first = stages.build_lake(spark, raw.filter(F.year("ingested_at") <= 1997), root, "b1")
    second = stages.build_lake(spark, raw, root, "b2")
    third = stages.build_lake(spark, raw, root, "b3")
    assert first.appended + second.appended == raw.count() and third.appended == 0
    assert third.silver == {"source_rows": 0, "inserted": 0, "updated": 0, "unchanged": 0}
    repeated = stages.build_lake(spark, raw, root, "b2")
    assert repeated.appended == second.appended and repeated.silver["inserted"] == 0
    gold = spark.read.parquet(repeated.gold).drop("event_year")
    direct = rollups.rollups(dedupe_latest(raw))
    assert same(direct, gold)
    assert lake.current_location(spark, f"{root}/audit", "gold") == repeated.gold
    history = lake.batch_history(spark.read.parquet(f"{root}/audit"), last=2).filter("table = 'gold'")
    # Runs that change nothing do not rebuild gold.
    assert rows_of(history.fillna(-1), "recency", "version", "previous_version") == [(1, 1, 0), (2, 0, -1)]


@pytest.mark.parametrize("stop_before", ["merge_into", "rebuild_partitioned", "record_batch"])
def test_interrupted_run_heals_under_a_new_batch_id(spark, events, tmp_path, monkeypatch, stop_before):
    raw, root = events((1, 1, "A", "N", 5, 1), (2, 2, "B", "N", 7, 1), (3, 3, "A", "N", -1, 1)), str(tmp_path)

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")
    with monkeypatch.context() as patched:
        patched.setattr(stages, stop_before, stop)
        with pytest.raises(RuntimeError):
            stages.build_lake(spark, raw, root, "b1")
    run = stages.build_lake(spark, raw, root, "b2")
    assert run.appended == 0
    assert same(spark.read.parquet(run.gold).drop("event_year"), rollups.rollups(raw.filter("id < 3")))
    assert {r.id for r in spark.read.parquet(f"{root}/rejects").collect()} == {3}


def test_batch_history_of_one_operation(spark):
    audit = spark.createDataFrame([("t", 0, "WRITE"), ("t", 1, "MERGE"), ("t", 2, "WRITE"), ("u", 0, "MERGE")],
                                  "table string, version long, operation string")
    got = rows_of(lake.batch_history(audit, "MERGE").fillna(-1), "table", "version", "previous_version")
    assert got == [("t", 1, 0), ("u", 0, -1)]
    assert lake.version_before(audit, "t", 2).first().version == 1
    assert lake.version_before(audit, "t", 0).first().version is None


def test_append_batch_replaces_its_own_batch(spark, events, tmp_path):
    path = str(tmp_path / "bronze")
    lake.append_batch(events((1, 1, "A", "N", 5, 1)), path, "x1")
    lake.append_batch(events((2, 1, "A", "N", 5, 1)), path, "x2")
    lake.append_batch(events((1, 1, "A", "N", 5, 1), (3, 1, "B", "N", 5, 1)), path, "x1")
    assert rows_of(spark.read.parquet(path), "id") == [(1,), (2,), (3,)]


def test_replace_one_model(spark, tmp_path):
    path = str(tmp_path / "forecast")
    frame = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "model_name string, yhat double")
    lake.replace_model_partition(frame, path)
    lake.replace_model_partition(frame.filter("model_name = 'a'").withColumn("yhat", F.lit(9.0)), path)
    assert rows_of(spark.read.parquet(path), "model_name", "yhat") == [("a", 9.0), ("b", 2.0)]


def test_staged_replace_of_a_table_that_is_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string").write.partitionBy("p").parquet(path)
    table = spark.read.parquet(path)
    lake.staged_replace(table.filter("p = 'a'").withColumn("v", F.col("v") + 10), path, ["p"])
    assert rows_of(spark.read.parquet(path), "p", "v") == [("a", 11), ("b", 2)]


def test_compact_keeps_content_and_detail_counts(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    rollups.rollups(dedupe_latest(sales_events(spark, SMALL))).repartition(12) \
        .write.partitionBy("product_category").parquet(source)
    lake.compact(spark, source, target, ["event_date"], ["product_category"])
    assert same(spark.read.parquet(source), spark.read.parquet(target))
    before, after = lake.table_detail(spark, source), lake.table_detail(spark, target)
    assert before.count() == after.count() == 6
    total = lambda df, c: df.agg(F.sum(c)).first()[0]
    assert total(after, "files") < total(before, "files") and total(after, "rows") == total(before, "rows")


def test_empty_history_is_refused(spark, events, tmp_path):
    with pytest.raises(ValueError, match="empty"):
        stages.build_lake(spark, events((1, 1, "A", "N", 5, 1)).limit(0), str(tmp_path), "1")


def test_batch_ids_of_digits(spark, events, tmp_path):
    root = str(tmp_path)
    ev = events((1, 1, "A", "N", 5, 1), (2, 2, "A", "N", 7, 2))
    stages.build_lake(spark, ev.filter("id = 1"), root, "001")
    assert stages.build_lake(spark, ev.filter("id = 1"), root, "001").appended == 1
    assert stages.build_lake(spark, ev, root, "002").appended == 1
    assert spark.read.parquet(f"{root}/bronze").count() == 2


def test_fingerprint(events):
    ev = events((1, 1, "A", "N", 5, 1), (2, 2, "A", "N", 7, 2))
    same_rows = ev.repartition(3).orderBy(F.desc("id")).select(*reversed(ev.columns))
    assert lake.fingerprint(ev).first() == lake.fingerprint(same_rows).first()
    assert lake.fingerprint(ev).first() != lake.fingerprint(ev.withColumn("units_sold", F.lit(1))).first()


def test_seals_show_changed_files(spark, tmp_path):
    path, seals = str(tmp_path / "t"), str(tmp_path / "seals")
    spark.range(4).selectExpr("id", "id % 2 p").write.partitionBy("p").parquet(path)
    lake.seal(spark, path, seals, "b1")
    assert lake.broken_seals(spark, path, seals, "b1").isEmpty()
    assert {r.file.split("/")[0] for r in lake.file_hashes(spark, path).collect()} == {"p=0", "p=1"}
    spark.range(9).selectExpr("id", "2 p").write.mode("append").partitionBy("p").parquet(path)
    first = sorted((tmp_path / "t" / "p=0").glob("*.parquet"))
    first[0].write_bytes(first[0].read_bytes() + b"x")
    (first[0].parent / f".{first[0].name}.crc").unlink(missing_ok=True)
    for file in (tmp_path / "t" / "p=1").glob("*.parquet"):
        file.unlink()
    changes = {r.file.split("/")[0]: r.change for r in lake.broken_seals(spark, path, seals, "b1").collect()}
    assert changes == {"p=0": "changed", "p=1": "missing", "p=2": "added"}


def arrivals(events, *months, first=0):
    rows = events(*[(first + k, 1 + k % 28, "A", "N", k, 1) for k in range(4 * len(months))])
    month = F.element_at(F.array(*[F.lit(m) for m in months]), (F.col("id") % len(months) + 1).cast("int"))
    return rows.withColumn("ingested_at", F.concat(month, F.lit("-03 10:00:00")).cast("timestamp_ntz"))


def test_only_batches_that_may_hold_rows_are_opened(spark, events, tmp_path):
    table, zone_path = str(tmp_path / "bronze"), str(tmp_path / "zones")
    batches = {"a": arrivals(events, "2021-01", "2021-02"), "b": arrivals(events, "2021-03", first=100), "c": arrivals(events, "2021-03", "2021-04", first=200)}
    for name, rows in batches.items():
        lake.append_batch(rows, table, name)
    everything = batches["a"].unionAll(batches["b"]).unionAll(batches["c"])
    new = arrivals(events, "2021-04", "2021-05", first=300)
    fresh, opened = zones.unknown_rows(everything.unionAll(new), table, zone_path)
    assert opened == ["c"]                                       # April is in it; May is new, the others are known
    assert rows_of(fresh, "id") == sorted(rows_of(new, "id"))
    assert zones.unknown_rows(everything, table, zone_path)[1] == []
    fresh, opened = zones.unknown_rows(batches["b"].filter("id > 101").unionAll(new), table, zone_path)
    assert opened == ["b", "c"] and rows_of(fresh, "id") == rows_of(new, "id")
    changed = everything.withColumn("id", F.when(F.col("id") == 1, 999).otherwise(F.col("id")))
    fresh, opened = zones.unknown_rows(changed, table, zone_path)
    assert opened == ["a"] and rows_of(fresh, "id") == [(999,)]
    fresh, opened = zones.unknown_rows(everything, table, zone_path, skip="b")
    assert opened == ["c"] and rows_of(fresh, "id") == rows_of(batches["b"], "id")


def test_rows_without_arrival_time(spark, events, tmp_path):
    table, zone_path = str(tmp_path / "bronze"), str(tmp_path / "zones")
    rows = events(*[(k, 1, "A", "N", k, 1) for k in range(4)])
    blank = rows.withColumn("ingested_at", F.when(F.col("id") < 2, F.lit(None)).otherwise(F.col("ingested_at")))
    lake.append_batch(blank.filter("id <> 1"), table, "a")
    fresh, opened = zones.unknown_rows(blank, table, zone_path)
    assert opened == ["a"] and rows_of(fresh, "id") == [(1,)]


def test_lake_run_opens_few_batches(spark, events, tmp_path, monkeypatch):
    raw, root, opened = arrivals(events, "2021-01", "2021-02", "2021-03"), str(tmp_path), []
    original = stages.unknown_rows

    def noted(*args, **kwargs):
        fresh, names = original(*args, **kwargs)
        opened.append(names)
        return fresh, names
    monkeypatch.setattr(stages, "unknown_rows", noted)
    for k, month in enumerate(("2021-02", "2021-03", "2021-04")):
        stages.build_lake(spark, raw.filter(F.col("ingested_at") < f"{month}-01"), root, f"b{k}")
    assert opened == [[], [], []] and spark.read.parquet(f"{root}/bronze").count() == 12


def test_silver_rows_carry_their_batch(spark, events, tmp_path):
    root = str(tmp_path)
    stages.build_lake(spark, events((1, 1, "A", "N", 5, 1), (2, 2, "A", "N", 5, 1)), root, "b1")
    stages.build_lake(spark, events((1, 1, "A", "N", 5, 1), (2, 2, "A", "N", 5, 1), (3, 2, "A", "N", 9, 2), (4, 3, "A", "N", 1, 2)), root, "b2")
    silver = spark.read.parquet(f"{root}/silver")
    assert rows_of(silver, "id", "_silver_batch_id") == [(1, "b1"), (3, "b2"), (4, "b2")]
    assert silver.filter("_silver_at is null").isEmpty()


def test_gate_refuses_the_whole_batch(events):
    good = events((1, 1, "A", "N", 5, 1))
    assert quality.assert_constraints(good, EVENTS) is good
    bad = [good.withColumn("unexpected", F.lit(1)), good.withColumn("units_sold", F.lit(-1)),
           good.withColumn("store_region", F.lit(None).cast("string")), good.drop("revenue"),
           good.withColumn("units_sold", F.col("units_sold").cast("bigint"))]
    for batch in bad:
        with pytest.raises(ValueError, match="refused"):
            quality.assert_constraints(batch, EVENTS)


def test_as_of_and_new_rows(events):
    bronze = events((1, 1, "A", "N", 5, 1), (2, 1, "A", "N", 7, 2)).withColumn("batch_seq", F.col("id"))
    assert upsert.as_of(bronze, 1).first().units_sold == 5
    assert upsert.as_of(bronze, 2).first().units_sold == 7
    assert rows_of(upsert.new_rows(bronze, bronze.filter("id = 1")), "id") == [(2,)]
    assert set(EVENT_KEY) <= set(upsert.stamp(bronze, "b", "s").columns)


def test_runs_of_a_lake_query_share_one_join(spark, monkeypatch):
    """The source of both runs is read from where it was written once."""
    read, build = [], stages.build_lake
    monkeypatch.setattr(stages, "build_lake", lambda spark, raw, *rest: read.extend(raw.inputFiles()) or build(spark, raw, *rest))
    assert QUERIES["lake_build"](spark, SMALL).count()
    assert read and not any(SMALL in file for file in read)
