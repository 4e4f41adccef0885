"""Equivalent SQL (DuckDB dialect) for the queries, to check results on the same tables.

A statement names the steps it needs; ``WITH`` clauses are put together from ``STEPS``.
"""

from __future__ import annotations

import re

from ..functions.dates import FIXED_HOLIDAYS, FLOATING_HOLIDAYS, HOLIDAY_NAMES

KEY = "event_date, product_category, store_region"
EVENT_COLUMNS = ("id, event_date, product_category, store_region, units_sold, revenue, avg_unit_price, "
                 "promotion_flag, ingested_at")


def _latest(source: str, where: str = "true", direction: str = "desc") -> str:
    return (f"select {EVENT_COLUMNS} from (select *, row_number() over (partition by {KEY} "
            f"order by ingested_at {direction}, id {direction}) rn from {source} where {where}) where rn = 1")


_JOINED = """lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
     join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
     join orders on l_orderkey = o_orderkey"""
_REVENUE = "cast(cast(l_extendedprice as decimal(14,2)) * (1 - cast(l_discount as decimal(4,2))) as decimal(14,2))"
_PRICE = ("cast(cast((2*cast(round(l_extendedprice*100) as bigint) + cast(l_quantity as bigint)) "
          "// (2*cast(l_quantity as bigint)) as decimal(18,0)) * cast(0.01 as decimal(3,2)) as decimal(10,2))")
_ID = "cast((l_orderkey*8 + l_linenumber)*1000000 + l_partkey as bigint)"


def _rollup(source: str) -> str:
    # The growth rate is rounded half up with integers: exact on ties.
    return f"""select event_date, product_category, daily_units, daily_revenue,
      cast(m7 as decimal(18,4)) rolling_avg_units_7d, cast(m30 as decimal(18,4)) rolling_avg_units_30d,
      case when ago <> 0 then cast(sign(daily_units - ago) * ((2000000 * abs(daily_units - ago) + ago) // (2 * ago))
           as decimal(18,0)) * cast(0.000001 as decimal(6,6)) end wow_growth_rate
    from (select *, avg(daily_units) over (partition by product_category order by event_date
                    range between interval 6 days preceding and current row) m7,
                 avg(daily_units) over (partition by product_category order by event_date
                    range between interval 29 days preceding and current row) m30,
                 lag(daily_units, 7) over (partition by product_category order by event_date) ago
          from ({source}))"""


def _daily(source: str) -> str:
    return f"""select event_date, product_category, cast(sum(units_sold) as bigint) daily_units,
      cast(sum(revenue) as decimal(24,2)) daily_revenue from {source} group by 1, 2"""


def _rows_mean(lag: int, width: int) -> str:
    frame = f"rows between {lag + width - 1} preceding and {lag} preceding"
    over = f"over (partition by product_category order by ds {frame})"
    return f"case when count(y) {over} = {width} then avg(y) {over} end"


def _holiday() -> str:
    number = {name: i + 1 for i, name in enumerate(HOLIDAY_NAMES)}
    wd = "(isodow(ds) - 1)"

    def fixed(expr: str, month: int, day: int, since: int) -> str:
        return f"(month({expr}) = {month} and day({expr}) = {day} and year({expr}) >= {since})"

    whens = [f"when {fixed('ds', m, d, y)} then {number[n]}" for n, m, d, y in FIXED_HOLIDAYS]
    whens += [f"when month(ds) = {m} and {wd} = {w} and day(ds) between {lo} and {hi} then {number[n]}"
              for n, m, w, lo, hi in FLOATING_HOLIDAYS]
    whens += [f"when ({wd} = 4 and {fixed('(ds + 1)', m, d, y)}) or ({wd} = 0 and {fixed('(ds - 1)', m, d, y)}) "
              f"then {number[n + ' (observed)']}" for n, m, d, y in FIXED_HOLIDAYS]
    return "cast(case " + " ".join(whens) + " else 0 end as integer)"


_PROFILE_SUMS = "daily_units daily_revenue rolling_avg_units_7d rolling_avg_units_30d wow_growth_rate".split()
_TOLERANCE = {"daily_units": "0", "daily_revenue": "0", "rolling_avg_units_7d": "0.0001",
              "rolling_avg_units_30d": "0.0001", "wow_growth_rate": "0.000001"}


def _profile(source: str) -> str:
    sums = ", ".join(f"sum({c}) sum_{c}" for c in _PROFILE_SUMS)
    return f"""select count(*) row_count, count(distinct (event_date, product_category)) distinct_keys,
      count(distinct product_category) categories, min(event_date) min_date, max(event_date) max_date,
      count(*) filter (where wow_growth_rate is null) null_wow_growth_rate, {sums} from {source}"""


def _reconcile(a: str, b: str) -> str:
    parts = []
    for c, tol in _TOLERANCE.items():
        both = "a.event_date is not null and b.event_date is not null"
        parts.append(f"count(*) filter (where {both} and a.{c} is distinct from b.{c} "
                     f"and coalesce(abs(a.{c} - b.{c}) > {tol}, true)) mismatch_{c}")
        parts.append(f"max(abs(a.{c} - b.{c})) filter (where {both}) max_diff_{c}")
    return f"""select count(*) filter (where b.event_date is null) only_in_left,
      count(*) filter (where a.event_date is null) only_in_right,
      count(*) filter (where a.event_date is not null and b.event_date is not null) matched, {', '.join(parts)}
    from {a} a full outer join {b} b on a.event_date = b.event_date and a.product_category = b.product_category"""


def _reconcile_lines(a: str, b: str) -> str:
    return " union all ".join(
        f"""select '{c}' "value", only_in_left left_only, only_in_right right_only, matched paired, mismatch_{c} beyond,
        cast(max_diff_{c} as double) widest from ({_reconcile(a, b)})""" for c in _TOLERANCE)


def _parity(layer: str, name: str, left: str, right: str, source: str, tol: str = "0", text: bool = False) -> str:
    a, b = f"({left})", f"({right})"
    diff = f"case when {a} <> {b} then 'differs' end" if text else f"cast(abs({a} - {b}) as varchar)"
    same = f"{a} = {b}" if text else f"abs({a} - {b}) <= ({tol})"
    return f"""select '{layer}' "layer", '{name}' check_name, cast({a} as varchar) left_value,
      cast({b} as varchar) right_value, {diff} abs_diff, cast({tol} as varchar) tolerance,
      case when ({a} is null and {b} is null) or coalesce({same}, false) then 'PASS' else 'FAIL' end status
    from {source}"""


def _parity_summary() -> str:
    source = "staged_profile l, silver_profile r"
    rows = [_parity("gold", c, f"l.{c}", f"r.{c}", source, text=c.endswith("date"))
            for c in ("row_count", "distinct_keys", "categories", "min_date", "max_date")]
    for c, tol in _TOLERANCE.items():
        scale = len(tol) - 2 if "." in tol else 0
        limit = f"cast({tol} as decimal(18,{scale})) * greatest(l.row_count, r.row_count)"
        rows.append(_parity("gold", f"sum_{c}", f"l.sum_{c}", f"r.sum_{c}", source, limit))
    rows.append(_parity("gold", "null_wow_growth_rate", "l.null_wow_growth_rate", "r.null_wow_growth_rate", source))
    return " union all ".join(rows)


def _parity_rows() -> str:
    rows = [_parity("gold", "rows_only_in_left", "only_in_left", "0", "two_rollups"),
            _parity("gold", "rows_only_in_right", "0", "only_in_right", "two_rollups"),
            _parity("gold", "has_matched_rows", "matched > 0", "true", "two_rollups", text=True)]
    for c, tol in _TOLERANCE.items():
        rows.append(_parity("gold", f"rows_mismatched_{c}", f"mismatch_{c}", "0", "two_rollups"))
        rows.append(_parity("gold", f"max_abs_diff_{c}", f"coalesce(max_diff_{c}, 0)", "0", "two_rollups", tol))
    return " union all ".join(rows)


def _checks(source: str, checks: list[tuple[str, str]], first: int = 0) -> str:
    return " union all ".join(
        f"select {first + i} \"position\", '{name}' check_name, cast(({count}) as bigint) failed_rows from {source}"
        for i, (name, count) in enumerate(checks))


def _fingerprint(source: str, columns: list[str]) -> str:
    texts = " || ',' || ".join(f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')" for c in columns)
    half = lambda start: f"cast(sum(('0x' || substr(h, {start}, 15))::BIGINT) as decimal(38,0))"
    return f"""select count(*) "rows", {half(1)} hash_low, {half(16)} hash_high from (select md5({texts}) h from {source})"""


def _contract(days: str, more: str = "") -> str:
    return f"""select product_category, 90 n_rows, 90 n_days, {days}, 0 missing_or_negative{more} from span"""


def _label(column: str) -> str:
    return f"case {column} when 'seasonal_naive' then 'Seasonal Naive' when 'lag_364' then 'Lag 364' else 'Level' end"


def _fact_lines() -> str:
    def span(start: str, end: str, years: int = 0) -> str:
        return " || ' to ' || ".join(f"cast(cast({x} - interval {years} years as date) as varchar)" for x in (start, end))
    one, signed = "format('{{:,.1f}}', {})", "printf('%+.1f', {})"
    move = f"string_agg(product_category || ' ' || {signed.format('yoy_pct')} || '%', ', ' order by abs(yoy_pct) desc, {{}})"
    grow, fall = move.format("product_category"), move.format("product_category desc")
    lines = [
        ("trend", "'all'", f"'Daily means over ' || {span('p_start', 'p_end')} || ' beside those of ' || {span('p_start', 'p_end', 1)}", "recent"),
        ("trend", "'all'", f"'Up on the year, strongest rise first: ' || coalesce({grow} filter (where yoy_pct > 0), 'none')", "movers"),
        ("trend", "'all'", f"'Down on the year, strongest fall first: ' || coalesce({fall} filter (where yoy_pct < 0), 'none')", "movers"),
        ("forecast", "'all'", f"'Forecast days ' || {span('p_start', 'p_end')} || ' beside ' || {span('p_start', 'p_end', 1)} || "
                              f"'; the growth before that is against ' || {span('p_start', 'p_end', 2)}", "ahead"),
        ("model", "'all'", f"'Errors are those of ' || {span('p_start', 'p_end')} || ', predicted from data up to ' || cast(p_start - 1 as varchar)", "recent"),
        ("trend", "product_category", "product_category || ' is ' || case when yoy_pct > 0 then 'up' when yoy_pct < 0 then 'down' else 'level' end || "
         f"': a daily mean of ' || {one.format('recent_avg')} || ' units after ' || {one.format('year_earlier_avg')} || "
         f"' twelve months before, a change of ' || {signed.format('yoy_pct')} || ' percent'", "yoy1"),
        ("forecast", "product_category", f"'Expected daily mean of ' || product_category || ': ' || {one.format('forecast_avg')} || "
         f"' units; on these dates a year ago it was ' || {one.format('same_dates_last_year_avg')} || '. Change ' || "
         f"{signed.format('forecast_yoy_pct')} || ' percent, the year before ' || {signed.format('prior_year_yoy_pct')} || ' percent'", "fyoy1"),
        ("model", "model", f"'Average percentage error of ' || {_label('model')} || ' on the holdout: ' || format('{{:,.2f}}', round_even(mean_mape, 2))", "means"),
        ("model", "a.model", f"{_label('a.model')} || ' errs least, by ' || format('{{:,.2f}}', round_even(b.mean_mape - a.mean_mape, 2)) || "
         f"' points before ' || {_label('b.model')}", _TWO_BEST),
        ("wins", "m.model", f"{_label('m.model')} || ' comes first for ' || count(b.product_category) || ' series out of ' || "
         "(select count(*) from best) || ': ' || coalesce(string_agg(b.product_category, ', ' order by b.product_category), 'none')",
         "(select distinct model from metrics) m left join best b on b.best_model = m.model group by m.model"),
        ("recommendation", "a.model", f"case when b.mean_mape - a.mean_mape < 0.5 then {_label('a.model')} || ' and ' || {_label('b.model')} || "
         f"' err equally; either will do' when a.model = 'seasonal_naive' then 'Stay with ' || {_label('a.model')} "
         f"else 'Change over to ' || {_label('a.model')} || ', which errs least' end", _TWO_BEST),
        ("wins", "'seasonal_naive'", "'Seasonal Naive is ahead of Lag 364 for ' || count(*) || ' series: ' || "
         "coalesce(string_agg(product_category, ', ' order by product_category), 'none')", f"({_BEATS})")]
    return " union all ".join(f"select '{section}' section, {subject} subject, {text} line from {source}" for section, subject, text, source in lines)


_TWO_BEST = ("(select * from means where mean_mape is not null order by mean_mape, model limit 1) a, "
             "(select * from means where mean_mape is not null order by mean_mape, model limit 1 offset 1) b")
_BEATS = """select * from (select product_category,
          max(round_even(mape, 2)) filter (where model = 'seasonal_naive') mape_a,
          max(round_even(mape, 2)) filter (where model = 'lag_364') mape_b from metrics group by 1) where mape_a < mape_b"""


def _failed(condition: str) -> str:
    return f"count(*) filter (where {condition})"


def _repeated(source: str, key: str) -> str:
    return f"select coalesce(sum(n), 0) from (select count(*) n from {source} group by {key}) where n > 1"


_REGIONS = "('AFRICA','AMERICA','ASIA','EUROPE','MIDDLE EAST')"
_CATEGORIES = "('ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD')"
_STAGING_OK = "event_date is not null and product_category is not null and units_sold >= 0"
_SILVER_OK = (f"{_STAGING_OK} and store_region is not null and revenue >= 0 and avg_unit_price is not null")
_STATUS = "case when failed_rows = 0 then 'PASS' else 'FAIL' end status"



# Step name -> query. Steps may use other steps and the test tables.
STEPS = {
    "ev": f"""select {_ID} id, cast(l_shipdate as date) event_date, p_type product_category, r_name store_region,
        cast(l_quantity as integer) units_sold, {_REVENUE} revenue, {_PRICE} avg_unit_price,
        l_discount >= 0.05 promotion_flag, o_orderdate ingested_at from {_JOINED}""",
    "deliveries": """select e.*, g.mark from (select *, case when year(ingested_at) <= 1996 then 1 when year(ingested_at) <= 1998 then 2 else 3 end n
          from ev) e join (select k n, (select max(event_date) - 30 from ev where year(ingested_at) <= case k when 1 then 0 when 2 then 1996 else 1998 end) mark
          from (values (1), (2), (3)) t(k)) g on g.n = e.n""",
    "batches": "select *, year(ingested_at) batch_seq from ev",
    "messy": f"""select {_ID} id,
        case when l_tax = 0.06 and l_discount = 0.07 then 'not a date' else cast(cast(l_shipdate as date) as varchar) end event_date,
        case when l_tax = 0.0 and l_discount = 0.0 then null when l_returnflag = 'A' then ' ' || p_type || '  ' else p_type end product_category,
        case when l_tax = 0.03 and l_discount = 0.1 then null when l_linestatus = 'F' then r_name || ' ' else r_name end store_region,
        case when l_tax = 0.02 and l_discount = 0.01 then null when l_tax = 0.01 and l_discount = 0.02
             then -cast(l_quantity as integer) else cast(l_quantity as integer) end units_sold,
        case when l_tax = 0.05 and l_discount = 0.08 then -{_REVENUE} else {_REVENUE} end revenue,
        case when l_tax = 0.04 and l_discount = 0.09 then null else {_PRICE} end avg_unit_price,
        case when l_discount = 0.0 then null else l_discount >= 0.05 end promotion_flag,
        o_orderdate ingested_at from {_JOINED}""",
    "typed": """select id, try_cast(event_date as date) event_date, trim(product_category) product_category,
        trim(store_region) store_region, units_sold, cast(revenue as decimal(14,2)) revenue, avg_unit_price,
        coalesce(promotion_flag, false) promotion_flag, ingested_at from messy""",
    "latest": _latest("ev"),
    "staged_latest": _latest("typed", _STAGING_OK),
    "silver_latest": _latest("typed", _SILVER_OK),
    "daily": _daily("latest"),
    "roll": _rollup("select * from daily"),
    "roll_2000": _rollup(_daily(f"({_latest('batches', 'batch_seq <= 2000')})")),
    "staged_roll": _rollup(_daily("staged_latest")),
    "silver_roll": _rollup(_daily("silver_latest")),
    "staged_profile": _profile("staged_roll"),
    "silver_profile": _profile("silver_roll"),
    "two_rollups": _reconcile("staged_roll", "silver_roll"),
    "mix": """select event_date, product_category, cast(sum(units_sold) as bigint) units_sold,
        cast(sum(revenue) as decimal(24,2)) revenue,
        cast(sum(revenue) as double) / nullif(cast(sum(units_sold) as double), 0) avg_unit_price,
        avg(cast(promotion_flag as integer)) promotion_rate, count(distinct store_region) region_count
        from latest group by 1, 2""",
    "dc": """select m.*, r.rolling_avg_units_7d, r.rolling_avg_units_30d, r.wow_growth_rate
        from mix m left join roll r on m.event_date = r.event_date and m.product_category = r.product_category""",
    "dim": """select row_number() over (order by product_category) category_id, product_category,
        case when product_category = 'Toys' then 'Highly seasonal (holiday-driven)'
             when product_category in ('Home & Garden', 'Sporting Goods') then 'Seasonal (weather-driven)'
             when product_category in ('Apparel', 'Books', 'Electronics') then 'Back-to-school / holiday influenced'
             else 'Steady demand' end seasonality_profile
        from (select distinct product_category from ev)""",
    "mart": """select event_date ds, product_category, units_sold y, revenue, avg_unit_price, promotion_rate,
        rolling_avg_units_7d, rolling_avg_units_30d, wow_growth_rate from dc""",
    "span": """select product_category, min(event_date) first_ds, max(event_date) last_ds, count(*) n_rows,
        cast(date_diff('day', min(event_date), max(event_date)) + 1 as integer) span_days from daily group by 1""",
    "cal": """select product_category, cast(unnest(generate_series(first_ds, last_ds, interval 1 day)) as date) ds
        from span""",
    "series": """select c.ds, c.product_category, coalesce(daily_units, 0) y,
        coalesce(daily_revenue, cast(0 as decimal(24,2))) revenue from cal c left join daily d
        on c.ds = d.event_date and c.product_category = d.product_category""",
    "split": """select *, ds > cutoff is_holdout from (select *, cast(max(ds) over (partition by product_category)
        - 90 as date) cutoff from series)""",
    "levels": f"""select *, {_rows_mean(90, 28)} "level", {_rows_mean(454, 28)} level_last_year from series""",
    "feat": f"""select ds, product_category, y, {_rows_mean(90, 28)} "level",
        {_rows_mean(90, 28)} / nullif({_rows_mean(454, 28)}, 0) level_yoy_growth,
        cast(lag(y, 357) over w as double) / nullif({_rows_mean(454, 28)}, 0) ly_ratio_357,
        cast(lag(y, 364) over w as double) / nullif({_rows_mean(454, 28)}, 0) ly_ratio_364,
        cast(lag(y, 371) over w as double) / nullif({_rows_mean(454, 28)}, 0) ly_ratio_371,
        {_rows_mean(361, 7)} / nullif({_rows_mean(454, 28)}, 0) ly_week_ratio,
        cast(y as double) / nullif({_rows_mean(90, 28)}, 0) target_ratio
        from series window w as (partition by product_category order by ds)""",
    "aged": "select *, date_diff('day', ds, cutoff) age from split",
    "growth": """select product_category, cast(sum(y) filter (where age between 0 and 363) as bigint) recent_units,
        cast(sum(y) filter (where age between 364 and 727) as bigint) earlier_units,
        case when count(*) filter (where age between 0 and 727) = 728
             then cast(sum(y) filter (where age between 0 and 363) as double)
                  / nullif(cast(sum(y) filter (where age between 364 and 727) as double), 0) end growth
        from aged group by 1""",
    "shifted": """select s.ds, s.product_category, s.y, p.y y_364d_ago from series s
        left join series p on p.product_category = s.product_category and p.ds = s.ds - 364""",
    "naive": """select s.ds, s.product_category, s.y, h.y_364d_ago * g.growth yhat from split s
        join shifted h on h.ds = s.ds and h.product_category = s.product_category
        join growth g on g.product_category = s.product_category where s.is_holdout""",
    "full_growth": """select product_category, case when count(*) filter (where age between 0 and 727) = 728
             then cast(sum(y) filter (where age between 0 and 363) as double)
                  / nullif(cast(sum(y) filter (where age between 364 and 727) as double), 0) end growth
        from (select s.*, date_diff('day', s.ds, last_ds) age from series s join span using (product_category)) group by 1""",
    "future": """select product_category, last_ds,
        cast(unnest(generate_series(last_ds + 1, last_ds + 90, interval 1 day)) as date) ds from span""",
    "forward": """select f.ds, f.product_category, f.last_ds, greatest(s.y * g.growth, 0.0) yhat,
        cast(case when date_diff('day', f.last_ds, f.ds) <= 30 then 30 when date_diff('day', f.last_ds, f.ds) <= 60
             then 60 else 90 end as integer) horizon_days
        from future f join series s on s.product_category = f.product_category and s.ds = f.ds - 364
        join full_growth g on g.product_category = f.product_category""",
    "pred": """select ds, product_category, y, 'seasonal_naive' model, yhat from naive
        union all select s.ds, s.product_category, s.y, 'lag_364', cast(h.y_364d_ago as double) from split s
        join shifted h on h.ds = s.ds and h.product_category = s.product_category where s.is_holdout
        union all select s.ds, s.product_category, s.y, 'level', l."level" from split s
        join levels l on l.ds = s.ds and l.product_category = s.product_category where s.is_holdout""",
    "metrics": """select product_category, model,
        case when count(*) filter (where yhat is null) = 0 then avg(abs((y - yhat) / nullif(y, 0))) * 100 end mape,
        case when count(*) filter (where yhat is null) = 0 then sqrt(avg((y - yhat) * (y - yhat))) end rmse
        from pred group by 1, 2""",
    "means": """select model, avg(mape) mean_mape, avg(rmse) mean_rmse, count(mape) n_series from metrics group by 1""",
    "monthly": """select cast(date_trunc('month', ds) as date) sales_month, product_category,
        cast(sum(y) as bigint) units_sold, cast(sum(revenue) as decimal(24,2)) revenue from series group by 1, 2""",
    "fc": "select ds, product_category, horizon_days, cast(yhat as decimal(18,4)) yhat from forward",
    "next90": """select product_category,
        round(sum(yhat) filter (where horizon_days <= 30)) forecast_units_30d,
        round(sum(yhat) filter (where horizon_days <= 60)) forecast_units_60d,
        round(sum(yhat)) forecast_units_90d from fc group by 1""",
    "last_month": "select max(sales_month) m from monthly",
    "prior": """select product_category, cast(sum(units_sold) as bigint) prior_units from monthly, last_month
        where sales_month between m - interval 11 months and m - interval 9 months group by 1""",
    "grown": """select n.product_category, forecast_units_90d,
        cast(forecast_units_90d as double) / cast(prior_units as double) - 1 growth
        from next90 n left join prior p on n.product_category = p.product_category""",
    "q4": """select cast(sum(units_sold) filter (where year(sales_month) = year(m)) as bigint) q4_units,
        cast(sum(units_sold) filter (where year(sales_month) = year(m) - 1) as bigint) q4_units_prior
        from monthly, last_month where month(sales_month) >= 10""",
    "recent": "select max(ds) - 89 as p_start, max(ds) as p_end from series",
    "periods": """select product_category,
        avg(y) filter (where ds between p_start and p_end) mean_now,
        avg(y) filter (where ds between p_start - interval 1 year and p_end - interval 1 year) mean_1y_ago,
        avg(y) filter (where ds between p_start - interval 2 years and p_end - interval 2 years) mean_2y_ago
        from series, recent group by 1""",
    "yoy": """select product_category, mean_now recent_avg, mean_1y_ago year_earlier_avg,
        (mean_now - mean_1y_ago) / nullif(mean_1y_ago, 0) * 100 yoy_pct from periods""",
    "yoy1": """select product_category, round_even(recent_avg, 1) recent_avg, round_even(year_earlier_avg, 1) year_earlier_avg,
        round_even(yoy_pct, 1) yoy_pct from yoy""",
    "movers": """select case when yoy_pct > 0 then 'growing' else 'declining' end direction, product_category, yoy_pct
        from yoy1 where yoy_pct <> 0""",
    "fyoy1": """select product_category, round_even(forecast_avg, 1) forecast_avg, round_even(ly, 1) same_dates_last_year_avg,
        round_even((forecast_avg - ly) / nullif(ly, 0) * 100, 1) forecast_yoy_pct,
        round_even((ly - ly2) / nullif(ly2, 0) * 100, 1) prior_year_yoy_pct from fyoy""",
    "ahead": "select min(ds) as p_start, max(ds) as p_end from forward",
    "fyoy": """select s.product_category, f.forecast_avg, s.ly, s.ly2 from (select product_category,
          avg(y) filter (where ds between p_start - interval 1 year and p_end - interval 1 year) ly,
          avg(y) filter (where ds between p_start - interval 2 years and p_end - interval 2 years) ly2
          from series, ahead group by 1) s
        left join (select product_category, avg(yhat) forecast_avg from forward group by 1) f
        on f.product_category = s.product_category""",
    "best": """select product_category, model best_model, round_even(mape, 2) mape from (
        select *, row_number() over (partition by product_category order by round_even(mape, 2),
          case model when 'level' then 0 when 'lag_364' then 1 else 2 end) rn from metrics where mape is not null)
        where rn = 1""",
    "bounds": """select product_category, quantile_cont(y - yhat, 0.1) residual_low,
        quantile_cont(y - yhat, 0.9) residual_high from naive group by 1""",
    "fva": """select s.ds, s.product_category, 'Actual' series, cast(y as double) units,
          cast(null as double) units_lower, cast(null as double) units_upper from split s where ds > cutoff - 90
        union all select ds, n.product_category, 'Backtest', greatest(yhat, 0.0), greatest(yhat + residual_low, 0.0),
          greatest(yhat + residual_high, 0.0) from naive n join bounds b on b.product_category = n.product_category
        union all select ds, n.product_category, 'Forecast', greatest(yhat, 0.0), greatest(yhat + residual_low, 0.0),
          greatest(yhat + residual_high, 0.0) from forward n join bounds b on b.product_category = n.product_category""",
    "eligibles": """select *, train_rows >= 60 and test_rows > 0 and incomplete_test_rows = 0 is_eligible from (
        select f.product_category, count(*) filter (where not is_holdout and ratios is not null and target_ratio is not null) train_rows,
          count(*) filter (where is_holdout) test_rows,
          count(*) filter (where is_holdout and (ratios is null or "level" is null)) incomplete_test_rows
        from (select *, level_yoy_growth + ly_ratio_357 + ly_ratio_364 + ly_ratio_371 + ly_week_ratio ratios from feat) f
        join split s on s.ds = f.ds and s.product_category = f.product_category group by 1)""",
    "last_cutoff": "select product_category, first_ds, last_ds - 90 train_last from span",
}

_MODEL_LABEL = "case model when 'seasonal_naive' then 'Seasonal Naive' when 'lag_364' then 'Lag 364' else 'Level' end"
_PCT = "printf('%+.1f%%', {} * 100)"
_MONEY = ("case when abs({0}) >= 1e6 then printf('$%.1fM', {0} / 1e6) "
          "else '$' || format('{{:,}}', cast(round_even({0}, 0) as bigint)) end")


def _rounded(columns: str) -> str:
    return ", ".join(f"round({c}, 6) {c}" for c in columns.split())


STATEMENTS = {
    "scan_mart": "select ds, product_category, y from mart",
    "replay_slice": f"""select event_date, product_category, units_sold, revenue, avg_unit_price, store_region,
        promotion_flag, ingested_at, id, false is_bad from (select *, row_number() over
        (order by {KEY}, ingested_at, id) pos from ev) where pos > 1000""",
    "parse_events": """select * replace (case when is_bad then null else event_date end as event_date,
          case when is_bad then null else product_category end as product_category,
          case when is_bad then null else units_sold end as units_sold,
          case when is_bad then null else revenue end as revenue,
          case when is_bad then null else avg_unit_price end as avg_unit_price,
          case when is_bad then null else store_region end as store_region,
          case when is_bad then null else promotion_flag end as promotion_flag)
        from (select event_date, product_category, units_sold, revenue, avg_unit_price, store_region, promotion_flag,
              ingested_at, id, units_sold < 3 or units_sold in (48, 49, 50) is_bad from ev)""",
    "replay_resume": "select * from ev",
    "type_events": f"select {EVENT_COLUMNS} from typed",
    "clean_staging": f"select {EVENT_COLUMNS} from typed where {_STAGING_OK}",
    "clean_silver": f"select {EVENT_COLUMNS} from typed where {_SILVER_OK}",
    "rejects": f"""select id, {KEY}, concat_ws('|', case when event_date is null then 'null_event_date' end,
        case when product_category is null then 'null_product_category' end,
        case when units_sold is null then 'null_units_sold' end, case when units_sold < 0 then 'negative_units_sold' end,
        case when store_region is null then 'null_store_region' end, case when revenue is null then 'null_revenue' end,
        case when revenue < 0 then 'negative_revenue' end, case when avg_unit_price is null then 'null_avg_unit_price' end)
        reasons from typed where not coalesce({_SILVER_OK}, false)""",
    "silver_rejects": f"""select id, {KEY}, concat_ws('|', case when event_date is null then 'null_event_date' end,
        case when product_category is null then 'null_product_category' end,
        case when units_sold is null then 'null_units_sold' end, case when units_sold < 0 then 'negative_units_sold' end,
        case when store_region is null then 'null_store_region' end, case when revenue is null then 'null_revenue' end,
        case when revenue < 0 then 'negative_revenue' end, case when avg_unit_price is null then 'null_avg_unit_price' end)
        reasons from typed where not coalesce({_SILVER_OK}, false)""",
    "dedupe_latest": "select * from latest",
    "dedupe_first": _latest("batches", f"""batch_seq >= 1998 and ({KEY}) not in
        (select ({KEY}) from batches where batch_seq < 1998)""", "asc"),
    "duplicate_stats": f"""select count(*) total_rows, count(distinct ({KEY})) distinct_keys,
        count(*) - count(distinct ({KEY})) duplicate_rows from ev""",
    "duplicate_groups": f"select {KEY}, count(*) n_records from ev group by {KEY} having count(*) > 1",
    "stg_rollups": "select * from roll",
    "bronze_new_rows": "select * from ev where ingested_at >= timestamp '1998-06-15 00:00:00'",
    "silver_audit": f"select id, {KEY}, case when year(ingested_at) <= 1998 then 'run1' else 'run2' end _silver_batch_id from latest",
    "table_detail": "select 'product_category=' || product_category \"partition\", count(*) \"rows\" from daily group by 1",
    "table_fingerprint": _fingerprint("ev", sorted(EVENT_COLUMNS.split(", "))),
    "replace_model": """select ds, product_category, case when model = 'level' then 0.0 else yhat end yhat, model model_name from pred""",
    "non_empty": """select 'events' what, case when count(*) > 0 then 'PASS' else 'FAIL' end status from ev
        union all select 'negative events', case when count(*) > 0 then 'PASS' else 'FAIL' end from ev where units_sold < 0""",
    "upsert_newer": "select * from latest",
    "upsert_metrics": f"""select count(n.id) source_rows, count(*) filter (where o.id is null) inserted,
        count(*) filter (where n.ingested_at > o.ingested_at or (n.ingested_at = o.ingested_at and n.id > o.id)) updated,
        count(*) filter (where not (n.ingested_at > o.ingested_at or (n.ingested_at = o.ingested_at and n.id > o.id))) unchanged
        from ({_latest('batches', 'batch_seq >= 1997')}) n
        left join ({_latest('batches', 'batch_seq <= 1998')}) o using ({KEY})""",
    "constraint_violations": "select check_name rule, failed_rows violations from (" + _checks("typed", [
        *[(f"{c} not null", _failed(f"{c} is null")) for c in
          (*KEY.split(", "), "units_sold", "revenue", "avg_unit_price", "promotion_flag", "id", "ingested_at")],
        ("units_sold_non_negative", _failed("units_sold < 0")), ("revenue_non_negative", _failed("revenue < 0"))]) + ")",
    "snapshot_diff": f"""select id, {KEY}, units_sold, case when n > 0 then 'left' else 'right' end side,
        cast(abs(n) as bigint) copies from (select id, {KEY}, units_sold, sum(s) n from (
          select *, 1 s from ({_latest('batches', 'batch_seq <= 1998')}) union all
          select *, -1 s from ({_latest('batches', 'batch_seq <= 1999')})) group by all) where n <> 0""",
    "silver_as_of": _latest("batches", "batch_seq <= 1998"),
    "batch_history": """select t "table", version, operation, source_rows, previous_version,
        cast(recency as integer) recency from (
        select t, version, operation, source_rows, lag(version) over (partition by t order by version) previous_version,
          row_number() over (partition by t order by version desc) recency
        from (select batch_seq - 1995 version, count(*) source_rows from batches group by 1),
          (values ('bronze', 'APPEND'), ('silver', 'MERGE')) v(t, operation)) where recency <= 5""",
    "lake_build": "select * from roll",
    "lake_recovery": "select * from roll",
    "compact_events": "select * from ev",
    "history_csv": """select event_date "date", product_category, units_sold, cast(revenue as double) revenue,
        cast(avg_unit_price as double) avg_unit_price, store_region, promotion_flag from ev""",
    "inferred_csv": """select event_date, product_category, cast(daily_units as bigint) daily_units,
        cast(cast(daily_units as varchar) || '00000000000000000000' as double) big,
        case when day(event_date) = 1 then '2024-99-99' else cast(event_date as varchar) end odd_date from daily""",
    "daily_totals": "select * from daily",
    "daily_mix": "select * from mix",
    "monthly_category": """select cast(date_trunc('month', ds) as date) sales_month, product_category,
        cast(sum(y) as bigint) units_sold, cast(sum(revenue) as decimal(24,2)) revenue from mart group by 1, 2""",
    "monthly_total": "select sales_month, cast(sum(revenue) as decimal(24,2)) total_revenue from monthly group by 1",
    "category_totals": """select product_category, cast(sum(units_sold) as bigint) units_sold from ev group by 1
        order by units_sold desc, product_category""",
    "month_by_category": "select cast(month(event_date) as integer) \"month\", " + ", ".join(
        f"avg(units_sold) filter (where product_category = '{c}') \"{c}\""
        for c in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")) + " from ev group by 1",
    "series_span": "select product_category, first_ds, last_ds, n_rows, span_days from span",
    "distinct_categories": "select distinct product_category from ev",
    "rolling_7d": """select *, avg(daily_units) over (partition by product_category order by event_date
        range between interval 6 days preceding and current row) rolling_avg_units_7d from daily""",
    "rolling_30d": """select *, avg(daily_units) over (partition by product_category order by event_date
        range between interval 29 days preceding and current row) rolling_avg_units_30d from daily""",
    "wow_rows": """select * exclude (ago), cast(daily_units - ago as double) / nullif(cast(ago as double), 0) wow_growth_rate
        from (select *, lag(daily_units, 7) over (partition by product_category order by event_date) ago from daily)""",
    "wow_days": """select d.*, cast(d.daily_units - p.daily_units as double) / nullif(cast(p.daily_units as double), 0)
        wow_growth_rate from daily d left join daily p on p.product_category = d.product_category
        and p.event_date = d.event_date - 7""",
    "rollups": "select * from roll",
    "daily_category": "select * from dc",
    "dim_category": "select * from dim",
    "fact_daily_sales": """select category_id, dc.product_category, event_date, units_sold, revenue, avg_unit_price,
        promotion_rate, rolling_avg_units_7d, rolling_avg_units_30d, wow_growth_rate
        from dc left join dim on dc.product_category = dim.product_category""",
    "forecast_mart": "select * from mart",
    "dq_suite": f"""select *, {_STATUS} from (""" + _checks("typed", [
        ("not_null(event_date)", _failed("event_date is null")),
        ("not_null(product_category)", _failed("product_category is null")),
        ("in_set(product_category)", _failed(f"product_category not in {_CATEGORIES}")),
        ("in_set(store_region)", _failed(f"store_region not in {_REGIONS}")),
        ("between(units_sold)", _failed("units_sold not between 0 and 100000")),
        ("between(revenue)", _failed("revenue not between 0 and 100000000")),
        ("between(avg_unit_price)", _failed("avg_unit_price not between 0 and 10000")),
        ("not_null(promotion_flag)", _failed("promotion_flag is null"))]) + " union all " + _checks(
        "(select 1)", [("unique(event_date,product_category,store_region)", _repeated("typed", KEY))], 8) + ")",
    "dq_unique_key": f"""select *, {_STATUS} from (""" + _checks("(select 1)", [
        ("unique(event_date,product_category,store_region)", _repeated("latest", KEY)),
        ("unique(event_date,product_category)", _repeated("latest", "event_date, product_category")),
        ("unique(id)", _repeated("latest", "id"))]) + ")",
    "gap_check": """select product_category, first_ds, last_ds, n_rows, span_days, span_days - n_rows missing_days,
        case when span_days = n_rows then 'PASS' else 'FAIL' end status from span""",
    "fill_calendar": "select * from series",
    "missing_days": """select c.ds, c.product_category from cal c left join daily d on c.ds = d.event_date
        and c.product_category = d.product_category where d.event_date is null""",
    "missing_from": f"""select id, {KEY} from batches where batch_seq <= 1998 and ({KEY}) not in
        (select ({KEY}) from batches where batch_seq > 1998)""",
    "profile": _profile("roll"),
    "reconcile": _reconcile_lines("roll", "roll_2000"),
    "parity_summary": _parity_summary(),
    "parity_rows": _parity_rows(),
    "key_counts": f"""select (select count(*) from ev) raw_rows, (select count(distinct ({KEY})) from ev) raw_distinct_keys,
        (select count(*) from batches where batch_seq > 2000) raw_rows_missing_from_bronze,
        (select count(*) from batches where batch_seq <= 2000) bronze_rows,
        (select count(distinct ({KEY})) from batches where batch_seq <= 2000) silver_rows,
        (select count(distinct ({KEY})) from batches where batch_seq <= 2000) silver_distinct_keys""",
    "parity_layers": " union all ".join([
        _parity("bronze", "raw_rows_missing_from_bronze", "select count(*) from batches where batch_seq > 2000", "0", "(select 1)"),
        _parity("silver", "row_count_vs_raw_distinct_keys", "select count(*) from latest",
                f"select count(distinct ({KEY})) from ev", "(select 1)"),
        _parity("silver", "distinct_keys_vs_raw_distinct_keys", f"select count(distinct ({KEY})) from latest",
                f"select count(distinct ({KEY})) from ev", "(select 1)")]),
    "time_split": "select * from split",
    "calendar_features": """select ds, product_category, cast(isodow(ds) - 1 as integer) dayofweek,
        cast(month(ds) as integer) "month", cast(day(ds) as integer) "day", cast(dayofyear(ds) as integer) dayofyear,
        cast(week(ds) as integer) weekofyear, cast(isodow(ds) >= 6 as integer) is_weekend from series""",
    "with_holidays": f"select ds, product_category, {_holiday()} us_holiday from series",
    "lagged_level": "select ds, product_category, y, \"level\", level_last_year from levels",
    "lag_features": "select * from feat",
    "eligible": "select * from eligibles",
    "shift_364": "select * from shifted",
    "trailing_growth": "select * from growth",
    "seasonal_naive": "select * from naive",
    "seasonal_naive_forward": "select * from forward",
    "rolling_origins": """select product_category, cast(train_to - cast(90 * k as integer) as date) cutoff from (
        select product_category, last_ds - 90 train_to, unnest(range(0, 1 + (date_diff('day', first_ds, last_ds - 90) - 540) // 90)) k
        from span where date_diff('day', first_ds, last_ds - 90) >= 540)""",
    "future_frame": "select * from future",
    "horizon_bucket": """select *, cast(case when date_diff('day', last_ds, ds) <= 30 then 30
        when date_diff('day', last_ds, ds) <= 60 then 60 else 90 end as integer) horizon_days from future""",
    "score_frame": "select ds, product_category, y, yhat from naive",
    "score": f"select product_category, model, {_rounded('mape rmse')} from metrics where model = 'seasonal_naive'",
    "interval": f"select product_category, {_rounded('residual_low residual_high')} from bounds",
    "forecast_vs_actual": f"""select ds, product_category, series, {_rounded('units units_lower units_upper')} from fva""",
    "model_comparison": f"select product_category, model, {_rounded('mape rmse')} from metrics",
    "model_means": f"select model, {_rounded('mean_mape mean_rmse')}, n_series from means",
    "winner": "select model, round(mean_mape, 6) mean_mape from means order by means.mean_mape, model limit 1",
    "mape_wide": "select product_category, " + ", ".join(
        f"round(max(mape) filter (where model = '{m}'), 6) {m}" for m in ("seasonal_naive", "lag_364", "level"))
        + " from metrics group by 1",
    "flatten_metrics": """select model || '.' || product_category || '.' || metric "key", round("value", 6) "value"
        from (select product_category, model, 'mape' metric, mape "value" from metrics
              union all select product_category, model, 'rmse', rmse from metrics) where "value" is not null""",
    "period_means": f"select product_category, {_rounded('mean_now mean_1y_ago mean_2y_ago')} from periods",
    "yoy_trend": "select * from yoy1",
    "yoy_ranking": """select direction, row_number() over (partition by direction order by abs(yoy_pct) desc,
          case when yoy_pct > 0 then product_category end, product_category desc) "position", product_category, yoy_pct
        from movers""",
    "forecast_yoy": "select * from fyoy1",
    "horizon_summary": """select product_category, round_even(avg(yhat) filter (where horizon_days = 30), 1) days_1_30,
        round_even(avg(yhat) filter (where horizon_days = 60), 1) days_31_60,
        round_even(avg(yhat) filter (where horizon_days = 90), 1) days_61_90 from forward group by 1""",
    "best_model": "select product_category, best_model, mape from best",
    "win_counts": """select m.model, count(b.product_category) wins, (select count(*) from best) n_series
        from (select distinct model from metrics) m left join best b on b.best_model = m.model group by 1""",
    "won_series": "select best_model model, product_category from best",
    "beats": _BEATS,
    "fact_lines": _fact_lines(),
    "best_param": """select product_category, cast(case model when 'level' then 0.001 when 'lag_364' then 0.01 else 0.1 end as double) flexibility,
          cv_mape_0_001, null::double cv_mape_0_005, cv_mape_0_01, null::double cv_mape_0_05, cv_mape_0_1
        from (select *, row_number() over (partition by product_category order by mape, case model when 'level' then 0 when 'lag_364' then 1 else 2 end) rn
              from metrics where mape is not null)
        join (select product_category, round(max(mape) filter (where model = 'level'), 3) cv_mape_0_001,
                round(max(mape) filter (where model = 'lag_364'), 3) cv_mape_0_01, round(max(mape) filter (where model = 'seasonal_naive'), 3) cv_mape_0_1
              from metrics group by 1) using (product_category) where rn = 1""",
    "trend_season_contract": _contract("last_ds - 89 first_ds, last_ds", ", 0 crossed, 0 saw_holdout"),
    "forecast_forward_contract": _contract("last_ds + 1 first_ds, last_ds + 90 last_ds", ", 0 crossed, 30 first_month"),
    "direct_tree_contract": _contract("last_ds - 89 first_ds, last_ds") + " where product_category in (select product_category from eligibles where is_eligible)",
    "recommendation": """select a.model best_model, b.model second_model, round(b.mean_mape - a.mean_mape, 6) gap_pp,
        case when b.mean_mape - a.mean_mape < 0.5 then 'tie' when a.model = 'seasonal_naive' then 'use_primary'
             else 'switch' end recommendation
        from (select * from means order by mean_mape, model limit 1) a,
             (select * from means order by mean_mape, model limit 1 offset 1) b""",
    "label_models": f"select product_category, {_MODEL_LABEL} model, {_rounded('mape rmse')} from metrics",
    "display_comparison": f"""select product_category, {_MODEL_LABEL} model, round_even(mape, 2) mape,
        round_even(rmse, 1) rmse from metrics""",
    "heatmap": f"""select product_category, case when model = 'seasonal_naive' then 'Naive' else {_MODEL_LABEL} end model,
        round_even(round_even(mape, 2), 1) mape from metrics""",
    "next_90": "select * from next90",
    "next_90_sorted": """select product_category, forecast_units_90d from next90
        order by forecast_units_90d desc, product_category""",
    "next_90_growth": f"""select product_category, forecast_units_90d, growth,
        format('{{:,}}', cast(forecast_units_90d as bigint)) || ' (' || {_PCT.format('growth')} || ')' growth_label
        from grown""",
    "monthly_revenue_m": """select sales_month, round_even(cast(sum(revenue) as double) / 1e6, 2) revenue_m
        from monthly group by 1""",
    "seasonal_index": """select product_category, cast(moy as integer) moy,
        strftime(make_date(2000, moy, 1), '%b') "month",
        cast(round_even(a * 100 / avg(a) over (partition by product_category), 0) as integer) seasonal_index
        from (select product_category, month(sales_month) moy, avg(units_sold / day(last_day(sales_month))) a
              from monthly group by 1, 2)""",
    "revenue_share": f"""select product_category, revenue, {_MONEY.format('cast(revenue as double)')} || ' (' ||
        printf('%.0f%%', cast(revenue as double) / cast(total as double) * 100) || ')' revenue_label
        from (select product_category, cast(sum(revenue) as decimal(24,2)) revenue,
              (select sum(revenue) from monthly) total from monthly group by 1)""",
    "q4_yoy": "select q4_units, q4_units_prior, cast(q4_units as double) / cast(q4_units_prior as double) - 1 q4_yoy from q4",
    "kpis": f"""select {_MONEY.format('t.rev')} total_revenue, printf('%.2fM', t.units / 1e6) units_sold,
        {_PCT.format('(cast(q4_units as double) / cast(q4_units_prior as double) - 1)')} q4_yoy,
        format('{{:,}}', cast(f.ahead as bigint)) forecast_90d,
        {_PCT.format('(f.ahead / p.prior - 1)')} forecast_growth, """ + ", ".join(
        f"printf('%.2f%%', (select mean_mape from means where model = '{m}')) mape_{m}"
        for m in ("seasonal_naive", "lag_364", "level")) + """
        from (select cast(sum(revenue) as double) rev, cast(sum(units_sold) as double) units from monthly) t, q4,
             (select cast(sum(forecast_units_90d) as double) ahead from next90) f,
             (select cast(sum(prior_units) as double) prior from prior) p""",
    "backtest_total": """select ds, round(sum(units) filter (where series = 'Actual'), 6) actual_units,
        round(sum(units) filter (where series = 'Backtest'), 6) backtest_units from fva
        where series <> 'Forecast' and ds between (select min(ds) from naive) and (select max(ds) from naive) group by 1""",
    "series_code": """select ds, product_category, series, units,
        cast(case series when 'Actual' then 0 when 'Forecast' then 1 else 2 end as integer) series_code from fva""",
    "stream_ingest": _latest("ev", direction="asc"),
    "stream_rollups": "select * from roll",
    "ingest_stats": f"""select run, cast(n as bigint) consumed, cast(case run when 'first' then keys else 0 end as bigint) written,
          cast(case run when 'first' then good - keys else good end as bigint) skipped, cast(n - good as bigint) quarantined, cast(0 as bigint) late
        from (values ('first'), ('replay')) r(run), (select count(*) n, count(*) filter (where not is_bad) good,
          count(distinct ({KEY})) filter (where not is_bad) keys from (select *, units_sold < 3 or units_sold in (48, 49, 50) is_bad from ev))""",
    "stream_late": f"""select id, 'late' status from deliveries where coalesce(event_date < mark, false)
        union all select id, 'stored' from ({_latest('deliveries', 'not coalesce(event_date < mark, false)', 'asc')})""",
    "stream_capped": _latest("(select * from ev order by ingested_at, id limit 3500)", direction="asc"),
}


def _steps_in(text: str) -> list[str]:
    words = set(re.findall(r"[a-z_0-9]+", text))
    return [name for name in STEPS if name in words]


def _needed(text: str) -> list[str]:
    """Steps a statement uses, directly or through others, in the order of definition."""
    found: set[str] = set()
    todo = _steps_in(text)
    while todo:
        name = todo.pop()
        if name not in found:
            found.add(name)
            todo += [n for n in _steps_in(STEPS[name]) if n != name]
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for n in _steps_in(STEPS[name]):
            if n != name:
                visit(n)
        order.append(name)

    for name in STEPS:
        if name in found:
            visit(name)
    return order


def statement(name: str) -> str:
    body = STATEMENTS[name]
    steps = ", ".join(f"{step} as ({STEPS[step]})" for step in _needed(body))
    return f"with {steps} {body}" if steps else body


def oracle_sql() -> dict[str, str]:
    return {name: statement(name) for name in STATEMENTS}
