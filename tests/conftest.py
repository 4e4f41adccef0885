import sys
from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from demandspark.schemas import EVENTS  # noqa: E402
from demandspark.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark__ui__enabled="false", spark__driver__memory="8g",
                            spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def events(spark):
    """Events from short tuples (id, day, category, region, units, hour of arrival)."""
    def make(*rows):
        full = [(i, date(2023, 1, day), cat, region, units, None if units is None else Decimal(units * 2),
                 Decimal("2.00"), False, datetime(2023, 2, 1, hour)) for i, day, cat, region, units, hour in rows]
        return spark.createDataFrame(full, EVENTS)
    return make


@pytest.fixture
def series(spark):
    """Gap-free daily series from {category: list of values}, starting at ``first``."""
    def make(values, first=date(2020, 1, 1)):
        rows = [(first + timedelta(days=i), cat, int(y)) for cat, ys in values.items() for i, y in enumerate(ys)]
        return spark.createDataFrame(rows, "ds date, product_category string, y bigint")
    return make


def rows_of(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())
