from datetime import date

import pytest
from pyspark.sql import functions as F

from demandspark.operators import parity, quality, rollups
from tests.conftest import rows_of


def test_suite_counts_and_gate(events):
    ev = events((1, 1, "A", "N", 5, 1), (2, 1, "A", "N", -7, 2), (3, 2, "X", None, 1, 1))
    results = quality.run_suite(ev, quality.sales_checks(["A"], ["N"]))
    failed = {r.check_name: r.failed_rows for r in results.collect() if r.status == "FAIL"}
    assert failed == {"in_set(product_category)": 1, "between(units_sold)": 1, "between(revenue)": 1,
                      "unique(event_date,product_category,store_region)": 2}
    with pytest.raises(ValueError, match="between"):
        quality.assert_suite(results)
    clean = events((1, 1, "A", "N", 5, 1))
    assert quality.assert_suite(quality.run_suite(clean, quality.sales_checks(["A"], ["N"]))).count() == 9


def test_suite_on_an_empty_table(events):
    empty = events((1, 1, "A", "N", 5, 1)).limit(0)
    assert all(r.status == "PASS" for r in quality.run_suite(empty, quality.sales_checks(["A"], ["N"])).collect())
    with pytest.raises(ValueError):
        quality.require_rows(empty)


def test_suite_scans_its_input_once(events):
    ev = events((1, 1, "A", "N", 5, 1))
    plan = quality.run_suite(ev, quality.sales_checks(["A"], ["N"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_calendar(spark):
    gaps = spark.createDataFrame([(date(2023, 1, d), "A", d) for d in (1, 2, 5)] + [(date(2023, 1, 3), "B", 1)],
                                 "ds date, product_category string, y bigint")
    filled = rows_of(quality.fill_calendar(gaps), "product_category", "ds", "y")
    assert filled == [("A", date(2023, 1, 1), 1), ("A", date(2023, 1, 2), 2), ("A", date(2023, 1, 3), 0),
                      ("A", date(2023, 1, 4), 0), ("A", date(2023, 1, 5), 5), ("B", date(2023, 1, 3), 1)]
    assert rows_of(quality.missing_days(gaps), "ds") == [(date(2023, 1, 3),), (date(2023, 1, 4),)]
    status = {r.product_category: r.status for r in quality.gap_check(gaps).collect()}
    assert status == {"A": "FAIL", "B": "PASS"}


def test_parity_row(spark):
    one = spark.range(1)
    n = F.lit(None).cast("int")
    cases = [(F.lit(1), F.lit(1), "number", 0, "PASS"), (n, n, "number", 0, "PASS"), (n, F.lit(5), "number", 0, "FAIL"),
             (F.lit(1.0), F.lit(1.5), "number", F.lit(0.5), "PASS"), (F.lit(1.0), F.lit(1.6), "number", F.lit(0.5), "FAIL"),
             (F.lit(True), F.lit(1), "text", 0, "FAIL"), (F.lit("a"), F.lit("a"), "text", 0, "PASS")]
    for left, right, kind, tol, status in cases:
        row = one.select(F.inline(F.array(parity.parity_row("gold", "x", left, right, kind, tol)))).first()
        assert row.status == status, (row, kind)


def test_parity_of_equal_and_changed_rollups(events):
    a = rollups.rollups(events(*[(d, d, "A", "N", d, 1) for d in range(1, 15)]))
    b = rollups.rollups(events(*[(d, d, "A", "N", d + (d == 9), 1) for d in range(1, 15)]))
    assert parity.assert_parity(parity.parity_summary(a, a)).count() == 11
    parity.assert_parity(parity.parity_rows(a, a))
    with pytest.raises(ValueError):
        parity.assert_parity(parity.parity_rows(a, b))
    lines = {r.value: r for r in parity.reconcile(a, b).collect()}
    assert (lines["daily_units"].beyond, lines["daily_units"].widest, lines["daily_units"].paired) == (1, 1.0, 14)


def test_reconcile_counts_repeated_and_null_keys(spark):
    def table(*rows):
        return spark.createDataFrame(rows, "k string, v int")
    left, right = table(("a", 1), ("a", 2), (None, 3), ("c", None)), table(("a", 1), (None, 5), ("c", 4), ("d", 1))
    row = parity.reconcile(left, right, ["k"], {"v": 1}).first()
    assert (row.left_only, row.right_only, row.paired, row.beyond, row.widest) == (1, 1, 2, 2, 2.0)
    assert parity.reconcile(left.limit(0), right.limit(0), ["k"], {"v": 1}).first().paired == 0


def test_parity_needs_matched_rows(events):
    a = rollups.rollups(events(*[(d, d, "A", "N", d, 1) for d in range(1, 15)]))
    with pytest.raises(ValueError):  # two empty tables have nothing in common
        parity.assert_parity(parity.parity_rows(a.limit(0), a.limit(0)))


def test_layers(events):
    raw = events((1, 1, "A", "N", 5, 1), (2, 1, "A", "N", 7, 2), (3, 2, "A", "N", 1, 1))
    silver = raw.filter("id > 1")
    parity.assert_parity(parity.parity_layers(raw, raw, silver))
    bad = {r.check_name for r in parity.parity_layers(raw, silver, raw).filter("status = 'FAIL'").collect()}
    assert bad == {"raw_rows_missing_from_bronze", "row_count_vs_raw_distinct_keys"}
    counts = parity.key_counts(raw, silver, silver).first()
    assert (counts.raw_rows, counts.raw_distinct_keys, counts.bronze_rows, counts.silver_rows) == (3, 2, 2, 2)
