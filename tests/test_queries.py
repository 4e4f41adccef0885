"""Registered queries against their SQL counterparts on the smallest tables.

By default one query per kind of operator; ``ALL_QUERIES=1`` runs all of them
(``python -m tests.compare 0.01`` does so on a larger scale).
"""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from demandspark.plans import oracle
from demandspark.plans.queries import QUERIES
from tests.compare import compare, connect
from tests.conftest import ROOT, SMALL

STATEMENTS = oracle.oracle_sql()
# Fitted models have no SQL counterpart, but contract queries that have one.
WITHOUT_SQL = {"trend_season", "rolling_cv", "tuned_param", "forecast_forward", "direct_tree", "trained_model_comparison"}
SAMPLE = {"replay_slice", "parse_events", "rejects", "dedupe_latest", "dedupe_first", "upsert_newer", "upsert_metrics",
          "snapshot_diff", "batch_history", "rollups", "daily_category", "fact_daily_sales", "dq_suite", "reconcile",
          "parity_summary", "parity_rows", "fill_calendar", "with_holidays", "lag_features", "seasonal_naive",
          "rolling_origins", "forecast_vs_actual", "model_comparison", "yoy_ranking", "forecast_yoy", "recommendation",
          "seasonal_index", "revenue_share", "kpis", "stream_ingest", "stream_rollups",
          "replay_resume", "ingest_stats", "stream_late", "stream_capped", "bronze_new_rows", "lake_build", "inferred_csv", "best_param", "fact_lines",
          "table_fingerprint", "silver_audit"}
EVERYTHING = os.environ.get("ALL_QUERIES") == "1"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_only_known_queries_lack_sql():
    assert set(QUERIES) - set(STATEMENTS) == WITHOUT_SQL
    assert set(STATEMENTS) <= set(QUERIES) <= set(entry.queries())


def test_queries_survive_a_missing_library_of_the_corpus_operators():
    code = ("import sys; sys.modules['xxhash'] = None; sys.modules['tokenizers'] = None;"
            "import __spark_entry__ as e; print(len(e.queries()))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT)
    assert out.returncode == 0 and int(out.stdout.split()[-1]) >= len(QUERIES), out.stderr


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(STATEMENTS if EVERYTHING else SAMPLE))
def test_query_equals_sql(spark, con, name):
    problems = compare(QUERIES[name](spark, SMALL), con, STATEMENTS[name])
    # At the smallest scale two of the three baselines may leave nothing to list.
    assert [p for p in problems if p != "no rows"] == []


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL if EVERYTHING else {"tuned_param"}))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0
