"""Table schemas, keys and value sets."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

# Keys of the event and daily tables, and what makes an event newer (fixed values).
EVENT_KEY = ("event_date", "product_category", "store_region")
DAILY_KEY = ("event_date", "product_category")
RECENCY = ("ingested_at", "id")

MONEY = T.DecimalType(14, 2)
PRICE = T.DecimalType(10, 2)
# Sums and averages use wider decimals than a single event, so that totals over very many
# events do not overflow; values are the same.
MONEY_TOTAL = T.DecimalType(24, 2)
AVERAGE = T.DecimalType(18, 4)
RATE = T.DecimalType(18, 6)

HISTORY_CSV = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("units_sold", T.IntegerType()),
    T.StructField("revenue", T.DoubleType()),
    T.StructField("avg_unit_price", T.DoubleType()),
    T.StructField("store_region", T.StringType()),
    T.StructField("promotion_flag", T.BooleanType()),
])

# One event message; the corrupt column receives messages that do not fit.
CORRUPT = "_corrupt_record"
MESSAGE = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("units_sold", T.IntegerType()),
    T.StructField("revenue", MONEY),
    T.StructField("avg_unit_price", PRICE),
    T.StructField("store_region", T.StringType()),
    T.StructField("promotion_flag", T.BooleanType()),
    T.StructField(CORRUPT, T.StringType()),
])

# Fields of a message without which no event can be stored (fixed values).
REQUIRED_FIELDS = ("date", "product_category", "units_sold", "revenue", "avg_unit_price", "store_region")

EVENTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("store_region", T.StringType()),
    T.StructField("units_sold", T.IntegerType()),
    T.StructField("revenue", MONEY),
    T.StructField("avg_unit_price", PRICE),
    T.StructField("promotion_flag", T.BooleanType()),
    T.StructField("ingested_at", T.TimestampNTZType()),
])

ROLLUP_VALUES = ("daily_units", "daily_revenue", "rolling_avg_units_7d", "rolling_avg_units_30d",
                 "wow_growth_rate")
# Largest allowed difference per row when two rollups are compared (fixed values).
ROW_TOLERANCE = {
    "daily_units": Decimal("0"),
    "daily_revenue": Decimal("0"),
    "rolling_avg_units_7d": Decimal("0.0001"),
    "rolling_avg_units_30d": Decimal("0.0001"),
    "wow_growth_rate": Decimal("0.000001"),
}

# Ranges of the sales domain (fixed values).
UNITS_RANGE = (0, 100_000)
REVENUE_RANGE = (0, 100_000_000)
PRICE_RANGE = (0, 10_000)

# Seasonality profile by category; all others are "Steady demand" (fixed values).
SEASONALITY_PROFILES = {
    "Highly seasonal (holiday-driven)": ("Toys",),
    "Seasonal (weather-driven)": ("Home & Garden", "Sporting Goods"),
    "Back-to-school / holiday influenced": ("Apparel", "Books", "Electronics"),
}
DEFAULT_PROFILE = "Steady demand"

# Display label and sort position of each model (fixed values).
MODEL_LABELS = {"prophet": "Prophet", "lightgbm": "LightGBM", "seasonal_naive": "Seasonal Naive",
                "trend_season": "Trend + Season", "direct_tree": "Direct Tree"}
MODEL_ORDER = {"prophet": 0, "trend_season": 0, "lightgbm": 1, "direct_tree": 1, "seasonal_naive": 2}

# Forecast settings (fixed values).
HOLDOUT_DAYS = 90
MIN_LAG = 90
SEASON_LAG = 364
LEVEL_WINDOW = 28
HORIZONS = (30, 60, 90)
CV_INITIAL_DAYS = 540
CV_PERIOD_DAYS = 90
FLEXIBILITY_GRID = (0.001, 0.005, 0.01, 0.05, 0.1)
TIE_MARGIN_PP = 0.5
SERIES_CODES = {"Actual": 0, "Forecast": 1, "Backtest": 2}
