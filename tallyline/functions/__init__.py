"""Column functions: money, months, endpoints."""

from tallyline.functions.money import daily_rate, dollars, mrr_dollars, percent_of
from tallyline.functions.months import (
    day_of, instant, month_bounds, month_key, month_of, month_range, shift_month, within,
)
from tallyline.functions.text import iso_instant, normalise_endpoint

__all__ = [
    "daily_rate", "day_of", "dollars", "instant", "iso_instant", "month_bounds", "month_key",
    "month_of", "month_range", "mrr_dollars", "normalise_endpoint", "percent_of", "shift_month",
    "within",
]
