"""Market calendar columns (the session time zone must be UTC, see session.py)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MARKET_ZONE = "America/New_York"
PRICE_WINDOW_DAYS = 10


def market_date(epoch_ms: Column) -> Column:
    """Epoch milliseconds to the New York calendar date."""
    return F.to_date(F.from_utc_timestamp(F.timestamp_millis(epoch_ms), MARKET_ZONE))


def last_completed_weekday(as_of: Column) -> Column:
    """The last Monday..Friday strictly before ``as_of``."""
    day = F.weekday(as_of)  # Monday = 0
    return F.date_sub(as_of, F.when(day == 0, 3).when(day == 6, 2).otherwise(1))


def price_window(as_of: Column) -> tuple[Column, Column]:
    end = last_completed_weekday(as_of)
    return F.date_sub(end, PRICE_WINDOW_DAYS), end
