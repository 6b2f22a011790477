"""Exact money arithmetic: whole cents in, fixed-point decimals out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
_WIDE = "decimal(28,0)"


def dollars(cents: Column) -> Column:
    """Cents as dollars with two decimals."""
    return (cents.cast(_WIDE) / F.lit(100)).cast(MONEY)


def _rounded_quotient(numerator: Column, denominator: Column) -> Column:
    """``round_half_up(numerator / denominator)`` in whole numbers, for non-negative operands."""
    n, d = numerator.cast(_WIDE), denominator.cast("decimal(19,0)")
    return F.call_function("div", n * 2 + d, d * 2)


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, two decimals, NULL when ``whole`` is NULL or 0."""
    usable = F.when(whole > 0, whole)
    return dollars(_rounded_quotient(part.cast(_WIDE) * 10000, usable))


def mrr_dollars(cents: Column, billing_cycle: Column) -> Column:
    """Monthly recurring revenue of a summed price. Sums first and divides once, so no drift."""
    return (
        F.when(billing_cycle == "monthly", dollars(cents))
        .when(billing_cycle == "annual", dollars(_rounded_quotient(cents, F.lit(12))))
    )


def _base_10k_weight(n: Column) -> Column:
    """How many extra base-10000 digits a whole number below 10**12 has."""
    return F.when(n >= 100_000_000, 2).when(n >= 10_000, 1).otherwise(0)


def _leading_10k_digit(n: Column) -> Column:
    return (
        F.when(n >= 100_000_000, F.call_function("div", n, F.lit(100_000_000)))
        .when(n >= 10_000, F.call_function("div", n, F.lit(10_000)))
        .otherwise(n)
    )


def daily_rate(price_cents: Column, days: Column) -> Column:
    """Price per day, rounded to the number of decimals SQL NUMERIC division yields.

    NUMERIC keeps at least 16 significant digits and works in base 10000, so the number
    of decimals follows the size of the quotient: 16 for 1..9999, four fewer for each
    further factor of 10000, four more below 1. Rounding *here* is what makes a later
    floor or ceil differ by a cent from exact arithmetic, so it has to be the same.
    """
    price, span = price_cents.cast("bigint"), days.cast("bigint")
    weight = (
        _base_10k_weight(price) - _base_10k_weight(span)
        - F.when(_leading_10k_digit(price) <= _leading_10k_digit(span), 1).otherwise(0)
    )
    # decimal(26,16) / decimal(10,0) carries 27 decimals: enough to round once more without error.
    exact = price.cast("decimal(26,16)") / F.when(span > 0, span).cast("decimal(10,0)")
    rate = "decimal(30,20)"
    return (
        F.when(weight >= 2, F.round(exact, 8).cast(rate))
        .when(weight == 1, F.round(exact, 12).cast(rate))
        .when(weight == 0, F.round(exact, 16).cast(rate))
        .otherwise(F.round(exact, 20).cast(rate))
    )
