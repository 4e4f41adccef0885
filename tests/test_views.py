"""Rollups kept current by deltas."""

import random
import time
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from demandspark.operators import rollups, upsert
from demandspark.schemas import EVENTS
from demandspark.streaming import views


def made(spark, rows):
    """Events from (id, date, category, units, hour of arrival)."""
    full = [(i, day, c, "N", units, units * 2, 2, True, None) for i, day, c, units in rows]
    kinds = "id long, event_date date, product_category string, store_region string, units_sold int, revenue int, avg_unit_price int, promotion_flag boolean, ingested_at string"
    frame = spark.createDataFrame(full, kinds)
    arrived = F.timestamp_seconds(F.col("id")).cast("timestamp_ntz")
    return frame.withColumn("ingested_at", arrived).select(*[F.col(f.name).cast(f.dataType) for f in EVENTS.fields])


def gold_equals_rebuild(spark, silver, view):
    expected = rollups.rollups(spark.read.parquet(silver))
    return upsert.snapshot_diff(expected, spark.read.parquet(f"{view}/gold").select(*expected.columns)).isEmpty()


START = date(2021, 1, 1)


def days(n, c, start=START, step=1, first_id=0):
    return [(first_id + k, start + timedelta(days=k * step), c, k % 9 + 1) for k in range(n)]


def test_only_touched_months_are_read(spark, tmp_path):
    silver, view = str(tmp_path / "silver"), str(tmp_path / "view")
    views.merge_and_refresh(spark, silver, view, made(spark, days(730, "A") + days(730, "B", first_id=1000)), "b0")
    assert gold_equals_rebuild(spark, silver, view)
    touched = {"2022-02-01", "2022-03-01", "2022-04-01", "2022-05-01"}  # 29 days around April reach March and May; March's reach February
    for table, allowed in ((silver, {"2022-04-01"}), (f"{view}/daily", touched - {"2022-02-01"}), (f"{view}/gold", {"2022-04-01", "2022-05-01"})):
        for folder in sorted((tmp_path / table.removeprefix(str(tmp_path) + "/")).glob("event_month=*"))[1:]:
            if folder.name.partition("=")[2] not in allowed:  # from here on these cannot be read
                for file in folder.glob("*.parquet"):
                    file.rename(file.with_suffix(".kept"))
                    file.write_bytes(b"not parquet")
    done = views.merge_and_refresh(spark, silver, view, made(spark, [(5000, date(2022, 4, 20), "A", 100)]), "b1")
    assert done == views.Refresh([date(2022, 4, 1)], [(date(2022, 3, 1), date(2022, 5, 1))], [date(2022, 4, 1), date(2022, 5, 1)])
    for file in tmp_path.rglob("*.kept"):
        file.replace(file.with_suffix(".parquet"))
        (file.parent / f".{file.stem}.parquet.crc").unlink(missing_ok=True)
    assert gold_equals_rebuild(spark, silver, view)


def test_sparse_series_widen_their_span(spark, tmp_path):
    """Rows 40 days apart: the seventh row ahead and behind lies most of a year away."""
    silver, view = str(tmp_path / "silver"), str(tmp_path / "view")
    views.merge_and_refresh(spark, silver, view, made(spark, days(30, "A", step=40) + days(900, "B", first_id=1000)), "b0")
    done = views.merge_and_refresh(spark, silver, view, made(spark, [(5000, START + timedelta(days=610), "A", 50), (5001, START + timedelta(days=1), "B", 50)]), "b1")
    assert gold_equals_rebuild(spark, silver, view) and len(done.read) == 2
    again = views.merge_and_refresh(spark, silver, view, made(spark, [(5000, START + timedelta(days=610), "A", 50)]), "b1")
    assert again == views.Refresh([], [], [])  # a replay changes nothing


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_batches_equals_a_rebuild(spark, tmp_path, seed):
    draw, silver, view = random.Random(seed), str(tmp_path / "silver"), str(tmp_path / "view")
    rows = [(k, START + timedelta(days=draw.randrange(500)), draw.choice("ABBBC"), draw.randrange(50)) for k in range(160)]
    for k in range(0, len(rows), 40):
        views.merge_and_refresh(spark, silver, view, made(spark, rows[k:k + 40]), f"b{k}")
        assert gold_equals_rebuild(spark, silver, view)


@pytest.mark.parametrize("step", ["replace_partitions", "refresh_months"])
def test_an_interrupted_refresh_is_completed(spark, tmp_path, monkeypatch, step):
    silver, view = str(tmp_path / "silver"), str(tmp_path / "view")
    views.merge_and_refresh(spark, silver, view, made(spark, days(60, "A")), "b0")

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")
    change = made(spark, [(900, date(2021, 1, 10), "A", 70)])
    with monkeypatch.context() as patched:
        patched.setattr(views, step, stop)
        with pytest.raises(RuntimeError):
            views.merge_and_refresh(spark, silver, view, change, "b1")
    views.merge_and_refresh(spark, silver, view, change, "b1")  # delivered again: silver knows it already
    assert gold_equals_rebuild(spark, silver, view)


def test_time_of_a_batch_does_not_follow_the_history(spark, tmp_path):
    seconds = {}
    for years in (1, 6):
        silver, view = str(tmp_path / f"silver{years}"), str(tmp_path / f"view{years}")
        views.merge_and_refresh(spark, silver, view, made(spark, days(365 * years, "A")), "b0")
        taken = []
        for k in range(3):
            batch = made(spark, [(9000 + k, START + timedelta(days=200), "A", 100 + k)])
            begun = time.perf_counter()
            views.merge_and_refresh(spark, silver, view, batch, f"b{k + 1}")
            taken.append(time.perf_counter() - begun)
        seconds[years] = min(taken)
    assert seconds[6] < 1.6 * seconds[1] + 0.5


def test_spans():
    d = date
    assert views.spans_around([d(2021, 3, 1)]) == [(d(2021, 1, 1), d(2021, 4, 1))]  # 29 days before 1 March is in January
    assert views.spans_around([d(2021, 12, 1), d(2021, 1, 1)]) == [(d(2020, 12, 1), d(2021, 3, 1)), (d(2021, 11, 1), d(2022, 1, 1))]
