"""Display and key formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(name: Column) -> Column:
    """``Home & Garden`` -> ``home-and-garden``."""
    plain = F.regexp_replace(F.lower(name), "&", "and")
    return F.regexp_replace(F.regexp_replace(plain, "[^0-9a-z]+", "-"), "^-+|-+$", "")


def metric_key(key: Column) -> Column:
    """A key in the alphabet metric stores accept, at most 250 characters.

    A longer key keeps its beginning and ends in a hash of the whole, so that different keys stay different.
    """
    plain = F.regexp_replace(key, r"[^0-9A-Za-z_\-. /]", "_")
    return F.when(F.length(plain) <= 250, plain).otherwise(F.concat(F.substring(plain, 1, 233), F.lit("-"), F.lpad(F.hex(F.xxhash64(key)), 16, "0")))


def format_thousands(value: Column, decimals: int = 0) -> Column:
    return F.format_number(value, decimals)


def format_money(value: Column) -> Column:
    """``$37.6M`` from a million up, otherwise whole dollars with thousands separators."""
    v = value.cast("double")
    millions = F.regexp_replace(F.format_number(v / 1e6, 1), ",", "")
    return F.when(F.abs(v) >= 1e6, F.concat(F.lit("$"), millions, F.lit("M"))) \
        .otherwise(F.concat(F.lit("$"), F.format_number(v, 0)))


def _signed(value: Column, decimals: int) -> Column:
    text = F.regexp_replace(F.format_number(value, decimals), ",", "")
    return F.when(text.startswith("-"), text).otherwise(F.concat(F.lit("+"), text))


def format_pct_change(value: Column) -> Column:
    """A ratio as ``+11.2%``."""
    return F.concat(_signed(value.cast("double") * 100, 1), F.lit("%"))


def format_signed(value: Column, decimals: int = 1) -> Column:
    return _signed(value.cast("double"), decimals)
