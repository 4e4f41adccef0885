from datetime import date
from decimal import Decimal

from demandspark.operators import marts, rollups
from demandspark.operators.indexing import with_row_index
from tests.conftest import rows_of


def days(events, units):
    return events(*[(i, day, "A", "N", u, 1) for i, (day, u) in enumerate(units.items())])


def test_rolling_means_use_calendar_days_and_partial_windows(events):
    daily = rollups.daily_totals(days(events, {1: 10, 2: 20, 9: 30}))
    got = rows_of(rollups.rolling_mean(daily, 7), "event_date", "rolling_avg_units_7d")
    assert got == [(date(2023, 1, 1), 10.0), (date(2023, 1, 2), 15.0), (date(2023, 1, 9), 30.0)]


def test_growth_by_rows_and_by_days_differ_with_a_gap(events):
    daily = rollups.daily_totals(days(events, {d: d for d in (1, 2, 3, 5, 6, 7, 8, 9)}))
    by_rows = {r.event_date.day: r.wow_growth_rate for r in rollups.wow_rows(daily).collect()}
    by_days = {r.event_date.day: r.wow_growth_rate for r in rollups.wow_days(daily).collect()}
    assert by_rows[9] == (9 - 1) / 1 and by_rows[8] is None
    assert by_days[9] == (9 - 2) / 2 and by_days[8] == 7.0


def test_growth_is_null_on_zero_base(events):
    daily = rollups.daily_totals(days(events, {d: 0 if d == 1 else 5 for d in range(1, 9)}))
    assert all(r.wow_growth_rate is None for r in rollups.wow_rows(daily).collect())


def test_rollup_types_and_values(events):
    out = rollups.rollups(days(events, {d: d for d in range(1, 10)}))
    types = dict(out.dtypes)
    assert types["daily_units"] == "bigint" and types["rolling_avg_units_7d"] == "decimal(18,4)"
    last = out.filter("event_date = '2023-01-09'").first()
    assert last.rolling_avg_units_7d == Decimal("6.0000")
    assert last.wow_growth_rate == Decimal("3.500000")


def test_all_windows_share_one_exchange_and_one_sort(events):
    out = rollups.rollups(days(events, {d: d for d in range(1, 10)}))
    plan = out._jdf.queryExecution().executedPlan().toString()
    tail = plan.split("Aggregate")[0]
    assert tail.count("Exchange hashpartitioning(product_category") == 1
    assert tail.count("Sort [product_category") == 1 and tail.count("Window [") == 1


def test_mix_price_is_weighted(events):
    ev = events((1, 1, "A", "N", 1, 1), (2, 1, "A", "S", 3, 1), (3, 2, "A", "N", 0, 1))
    mix = {r.event_date.day: r for r in rollups.daily_mix(ev).collect()}
    assert mix[1].avg_unit_price == 2.0 and mix[1].region_count == 2 and mix[1].units_sold == 4
    assert mix[2].avg_unit_price is None


def test_fused_daily_table_equals_the_join(events):
    ev = days(events, {d: d * d for d in range(1, 20)})
    joined = marts.daily_category(rollups.daily_mix(ev), rollups.rollups(ev))
    fused = marts.daily_category_from_events(ev)
    fused = fused.select(*joined.columns)
    assert joined.exceptAll(fused).isEmpty() and fused.exceptAll(joined).isEmpty()


def test_dimension_ids_follow_names(spark):
    names = spark.createDataFrame([(c,) for c in ("Toys", "Apparel", "Zeta", "Toys")], "product_category string")
    got = rows_of(marts.dim_category(names), "category_id", "product_category", "seasonality_profile")
    assert got == [(1, "Apparel", "Back-to-school / holiday influenced"), (2, "Toys", "Highly seasonal (holiday-driven)"),
                   (3, "Zeta", "Steady demand")]


def test_row_index_is_the_global_position(spark):
    values = spark.range(5_000, numPartitions=7).selectExpr("(id * 7919) % 5000 v", "id % 3 g")
    indexed = with_row_index(values, ["v"], "pos").collect()
    assert all(r.pos == r.v + 1 for r in indexed) and len(indexed) == 5_000


def test_monthly_and_span(series):
    s = series({"A": range(60)}).selectExpr("*", "cast(y as decimal(24,2)) revenue")
    months = rows_of(marts.monthly_category(s), "sales_month", "units_sold")
    assert months == [(date(2020, 1, 1), sum(range(31))), (date(2020, 2, 1), sum(range(31, 60)))]
    span = marts.series_span(s).first()
    assert (span.span_days, span.n_rows) == (60, 60)
