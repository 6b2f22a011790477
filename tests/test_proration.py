"""Proration: the worked example, rounding, refusals, idempotent recording."""

from datetime import datetime, timedelta
from decimal import ROUND_CEILING, ROUND_FLOOR, ROUND_HALF_UP, Decimal, localcontext

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyline import scratch_dir
from tallyline.operators import proration
from tallyline.sources.lake import read_monthly
from tallyline.sources.schema import schema_of
from tests.seed import seed_tables

_CHANGE = (
    "tenant_id string, old_plan_id string, new_plan_id string, effective_at timestamp, period_start timestamp, "
    "period_end timestamp, subscription_id string"
)


def day(text):
    return datetime.fromisoformat(text)


def change(old, new, effective, start, end):
    return ("t4", old, new, day(effective), day(start), day(end), "s4")


def plans_of(spark, *prices, cycle="monthly"):
    return spark.createDataFrame(
        [(f"p{price}", price, cycle) for price in sorted(set(prices))], "id string, price_cents int, billing_cycle string",
    )


def amounts(spark, rows, plans, **options):
    ok = proration.prorate(spark.createDataFrame(rows, _CHANGE), plans, **options).ok
    return [
        (r["days_remaining"], r["days_in_cycle"], r["credit_cents"], r["charge_cents"], r["net_cents"])
        for r in ok.orderBy("effective_at").collect()
    ]


@pytest.mark.parametrize("exact", [False, True])
def test_worked_example(spark, exact):
    plans = plans_of(spark, 3750, 11250)
    row = change("p3750", "p11250", "2025-05-21 15:25:00", "2025-04-28", "2025-05-29")
    assert amounts(spark, [row], plans, exact=exact) == [(8, 31, 967, 2904, 1937)]


def test_rounding_the_rate_costs_a_cent(spark):
    plans = plans_of(spark, 1000, 2900)
    row = change("p1000", "p2900", "2024-09-15", "2024-08-31", "2024-09-30")
    assert amounts(spark, [row], plans) == [(15, 30, 499, 1451, 952)]
    assert amounts(spark, [row], plans, exact=True) == [(15, 30, 500, 1450, 950)]


def test_last_day_and_later_count_as_one_day(spark):
    plans = plans_of(spark, 3000, 6000)
    rows = [
        change("p3000", "p6000", "2024-09-30 10:00:00", "2024-08-31", "2024-09-30"),
        change("p3000", "p6000", "2024-10-09", "2024-08-31", "2024-09-30"),
    ]
    assert amounts(spark, rows, plans) == [(1, 30, 100, 200, 100)] * 2


def test_refusals_in_order(spark):
    plans = plans_of(spark, 1, 2)
    rows = [
        change("p0", "p0", "2024-09-15", "2024-09-01", "2024-09-01"),
        change("p1", "p0", "2024-09-15", "2024-09-01", "2024-09-01"),
        change("p1", "p2", "2024-09-15", "2024-09-01", "2024-09-01"),
        change("p1", "p2", "2024-08-15", "2024-09-01", "2024-10-01"),
        change("p1", "p1", "2024-09-15", "2024-09-01", "2024-10-01"),
        ("t4", "p1", "p2", None, day("2024-09-01"), day("2024-10-01"), "s4"),
        change("p1", "p2", "2024-09-15", "2024-09-01", "2024-10-01"),
    ]
    result = proration.prorate(spark.createDataFrame(rows, _CHANGE), plans)
    assert sorted(r["reject_reason"] for r in result.rejected.collect()) == sorted([
        proration.OLD_PLAN_MISSING, proration.NEW_PLAN_MISSING, proration.PERIOD_INVALID,
        proration.EFFECTIVE_TOO_EARLY, proration.SAME_PLAN, proration.INCOMPLETE,
    ])
    assert result.ok.count() == 1


def test_cycle_mismatch_is_marked(spark):
    plans = plans_of(spark, 100).union(plans_of(spark, 200, cycle="annual"))
    row = change("p100", "p200", "2024-09-15", "2024-09-01", "2024-10-01")
    ok = proration.prorate(spark.createDataFrame([row], _CHANGE), plans).ok
    assert [r["warn_cycle_mismatch"] for r in ok.collect()] == [True]


def test_a_downgrade_is_a_credit(spark):
    plans = plans_of(spark, 2900, 9900).union(plans_of(spark, 2900).selectExpr("'q'", "price_cents", "billing_cycle"))
    rows = [
        change("p9900", "p2900", "2024-09-15", "2024-08-31", "2024-09-30"),
        change("p2900", "p9900", "2024-09-16", "2024-08-31", "2024-09-30"),
        change("p2900", "q", "2024-09-15", "2024-08-31", "2024-09-30"),
    ]
    nets = proration.proration_invoices(proration.prorate(spark.createDataFrame(rows, _CHANGE), plans).ok)
    assert [r["credit_cents"] for r in nets.credits.collect()] == [3499]
    assert sorted(r["amount_cents"] for r in nets.invoices.collect()) == [1, 3267]


def numeric_rate(price: int, days: int) -> Decimal:
    """Independent statement of the rate: at least 16 significant digits, counted in base 10000."""
    def lead(n):
        weight = 0
        while n >= 10000 ** (weight + 1):
            weight += 1
        return weight, n // 10000**weight

    (pw, pd), (dw, dd) = lead(price), lead(days)
    places = 16 - 4 * (pw - dw - (pd <= dd))
    with localcontext() as context:
        context.prec = 80
        return (Decimal(price) / days).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(
    st.tuples(
        st.one_of(st.integers(0, 50_000), st.integers(0, 2**31 - 1)),
        st.one_of(st.integers(0, 50_000), st.integers(0, 2**31 - 1)),
        st.integers(1, 400), st.integers(0, 399),
    ),
    min_size=30, max_size=60, unique_by=lambda c: c[:2],
).map(lambda cases: [c for c in cases if c[0] != c[1]]))
def test_amounts_follow_the_rounded_rate(spark, cases):
    start = datetime(2023, 1, 1)
    plans = plans_of(spark, *[c[0] for c in cases], *[c[1] for c in cases])
    rows = [
        (str(n), f"p{old}", f"p{new}", start + timedelta(days=gone % cycle), start, start + timedelta(days=cycle), "s")
        for n, (old, new, cycle, gone) in enumerate(cases)
    ]
    found = {
        int(r["tenant_id"]): r for r in proration.prorate(spark.createDataFrame(rows, _CHANGE), plans).ok.collect()
    }
    for n, (old, new, cycle, gone) in enumerate(cases):
        days, row = cycle - gone % cycle, found[n]
        assert row["old_daily_rate"] == numeric_rate(old, cycle)
        assert row["credit_cents"] == int((numeric_rate(old, cycle) * days).to_integral_value(ROUND_FLOOR))
        assert row["charge_cents"] == int((numeric_rate(new, cycle) * days).to_integral_value(ROUND_CEILING))
        assert row["net_cents"] == row["charge_cents"] - row["credit_cents"]
        assert 1 <= row["days_remaining"] <= row["days_in_cycle"]


def test_an_equal_price_nets_at_most_two_cents(spark):
    plans = plans_of(spark, 2900).union(plans_of(spark, 2900).selectExpr("'q' AS id", "price_cents", "billing_cycle"))
    rows = [
        ("t", "p2900", "q", datetime(2024, 1, 1) + timedelta(days=d), datetime(2024, 1, 1), datetime(2024, 1, 32 - 1), "s")
        for d in range(30)
    ]
    assert {net for *_, net in amounts(spark, rows, plans)} <= {0, 1, 2}


def test_recording_twice_records_once(spark):
    t = seed_tables(spark)
    rows = [
        change("p2", "p3", "2024-09-15 11:05:00", "2024-08-31", "2024-09-30"),
        change("p3", "p2", "2024-10-20", "2024-10-01", "2024-10-31"),
    ]
    path = f"{scratch_dir(spark, 'test')}/events"
    for batch in (rows[:1], rows, rows):
        proration.write_plan_changes(spark, proration.prorate(spark.createDataFrame(batch, _CHANGE), t.plans).ok, path)
    stored = read_monthly(spark, path, schema_of("plan_change_events")).orderBy("effective_at").collect()
    assert [(r["month"], r["net_cents"]) for r in stored] == [("2024-09", 3750), ("2024-10", -2750)]
