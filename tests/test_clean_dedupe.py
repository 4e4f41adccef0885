from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from demandspark.operators import clean, dedupe, upsert
from tests.conftest import rows_of

RAW = ("id bigint, event_date string, product_category string, store_region string, units_sold int, "
       "revenue double, avg_unit_price double, promotion_flag boolean, ingested_at timestamp_ntz")


@pytest.fixture
def raw(spark):
    t = datetime(2023, 1, 2)
    return spark.createDataFrame([
        (1, "2023-01-01", " A ", "N", 5, 10.0, 2.0, None, t),
        (2, "2023-01-01", "A", " N", 5, 10.0, 2.0, True, t),
        (3, "2023-01-01", "A", "N", None, 10.0, 2.0, True, t),
        (4, "2023-01-01", "A", "N", -1, 10.0, 2.0, True, t),
        (5, "2023-01-01", "A", None, 1, 10.0, 2.0, True, t),
        (6, "2023-01-01", "A", "N", 1, 10.0, None, True, t),
        (7, "2023-01-01", "A", "N", 1, -1.0, 2.0, True, t),
        (8, "no date", "A", "N", 1, 1.0, 2.0, True, t)], RAW)


def test_typing_trims_and_defaults(raw):
    first = clean.type_events(raw).filter("id = 1").first()
    assert (first.product_category, first.promotion_flag, first.revenue) == ("A", False, Decimal("10.00"))
    assert first.event_date == date(2023, 1, 1)


def test_untrimmed_names_are_one_group(raw):
    typed = clean.type_events(raw).filter("id <= 2")
    assert typed.select("product_category", "store_region").distinct().count() == 1


def test_staging_and_silver_rules(raw):
    typed = clean.type_events(raw)
    assert rows_of(clean.clean(typed, "staging"), "id") == [(1,), (2,), (5,), (6,), (7,)]
    assert rows_of(clean.clean(typed, "silver"), "id") == [(1,), (2,)]


@pytest.mark.parametrize("rules", ["staging", "silver"])
def test_rejects_are_the_complement(raw, rules):
    typed = clean.type_events(raw)
    kept, dropped = clean.clean(typed, rules), clean.rejects(typed, rules)
    assert {r.id for r in kept.collect()} | {r.id for r in dropped.collect()} == set(range(1, 9))
    assert kept.count() + dropped.count() == 8
    assert dropped.filter(F.size("reasons") == 0).isEmpty()


def test_unknown_rules(raw):
    with pytest.raises(ValueError):
        clean.clean(raw, "gold")


def test_latest_and_first_wins(events):
    ev = events((1, 1, "A", "N", 5, 1), (2, 1, "A", "N", 7, 2), (3, 2, "A", "N", 1, 1), (4, 2, "A", "N", 2, 1))
    assert rows_of(dedupe.dedupe_latest(ev), "id") == [(2,), (4,)]
    assert rows_of(dedupe.keep_first(ev), "id") == [(1,), (3,)]
    assert dedupe.dedupe_latest(ev).columns == ev.columns


def test_latest_keeps_null_values_of_the_latest_row(events):
    ev = events((1, 1, "A", "N", 5, 1), (2, 1, "A", "N", None, 2))
    assert dedupe.dedupe_latest(ev).first().units_sold is None


def test_latest_with_selected_columns(events):
    ev = events((1, 1, "A", "N", 5, 1), (2, 1, "A", "N", 7, 2))
    slim = dedupe.dedupe_latest(ev, columns=["event_date", "product_category", "store_region", "units_sold"])
    assert slim.columns == ["event_date", "product_category", "store_region", "units_sold"]
    assert slim.first().units_sold == 7


def test_dedupe_first_skips_stored_keys(events):
    stored = events((1, 1, "A", "N", 5, 1))
    new = events((2, 1, "A", "N", 9, 2), (3, 2, "A", "N", 1, 5), (4, 2, "A", "N", 2, 4))
    assert rows_of(dedupe.dedupe_first(new, stored), "id") == [(4,)]


def test_duplicate_counts(events):
    ev = events((1, 1, "A", "N", 5, 1), (2, 1, "A", "N", 7, 2), (3, 2, "A", "N", 1, 1))
    stats = dedupe.duplicate_stats(ev).first()
    assert (stats.total_rows, stats.distinct_keys, stats.duplicate_rows) == (3, 2, 1)
    assert dedupe.duplicate_stats(ev.limit(0)).first().total_rows == 0
    assert [r.n_records for r in dedupe.duplicate_groups(ev).collect()] == [2]


def test_hot_key_is_combined_before_the_shuffle(spark, events):
    # One key holds nearly all rows: after the map side it is one row per task.
    hot = spark.range(200_000, numPartitions=8).selectExpr(
        "id", "date'2023-01-01' event_date", "'A' product_category", "'N' store_region", "cast(id % 10 as int) units_sold",
        "cast(1 as decimal(14,2)) revenue", "cast(1 as decimal(10,2)) avg_unit_price", "false promotion_flag",
        "timestamp_ntz'2023-01-01 00:00:00' ingested_at")
    latest = dedupe.dedupe_latest(hot)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "SortAggregate" not in plan and "ObjectHash" not in plan and "Sort [" not in plan
    assert latest.collect()[0].id == 199_999


def test_packed_order_equals_struct_order(spark):
    rows = [(k % 3 if k % 7 else None, datetime(1960 + k % 60, 1, 1) if k % 5 else None, (k * 7919) % 101 - 50 if k % 11 else None,
             k if k % 4 else None) for k in range(400)]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, id long, v int")
    for pick, first in ((dedupe.dedupe_latest, False), (dedupe.keep_first, True)):
        got = pick(df, ["k"], ["t", "id"]).collect()
        for r in got:
            mine = [x for x in rows if x[0] == r.k]
            key = lambda x: (x[1] is not None, x[1] or datetime.min, x[2] is not None, x[2] or 0)
            best = min(map(key, mine)) if first else max(map(key, mine))
            assert (r.k, r.t, r.id, r.v) in [x for x in mine if key(x) == best]


def test_null_key_parts_are_equal(events):
    rows = [(1, 1, "A", None, 5, 1), (2, 1, None, "N", 7, 2)]
    stored = events(*rows)
    assert dedupe.dedupe_first(events(*rows, (3, 1, None, None, 1, 3)), stored).count() == 1
    again = upsert.upsert_newer(stored, stored)
    assert again.count() == 2 and upsert.upsert_metrics(stored, stored).first().unchanged == 2
