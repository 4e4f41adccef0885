from .dates import calendar_columns, holiday_code
from .stats import mape, rmse
from .text import format_money, format_pct_change, format_thousands, metric_key, slug

__all__ = ["calendar_columns", "holiday_code", "mape", "rmse", "format_money", "format_pct_change",
           "format_thousands", "metric_key", "slug"]
