import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickerloom.operators import alpha as A

DAY = dt.date(2021, 1, 4)


def day(n):
    return DAY + dt.timedelta(days=n)


def brute(prices, bench, ticker, event):
    """Follow the definition for one event."""
    own = {d: c for t, d, c in prices if t == ticker and c is not None}
    ahead = sorted(d for d in own if d in bench and bench[d] is not None
                   and event < d < event + dt.timedelta(days=35))
    if len(ahead) < 3:
        return None
    first, third = ahead[0], ahead[2]
    if own[first] <= 0 or bench[first] <= 0:
        return None
    return ((own[third] - own[first]) / own[first]
            - (bench[third] - bench[first]) / bench[first])


def alphas(spark, prices, bench, events):
    p = spark.createDataFrame(prices, "ticker string, date date, close double")
    b = spark.createDataFrame(list(bench.items()), "date date, close double")
    e = spark.createDataFrame(events, "ticker string, event_date date")
    joined = A.next_trading_day_join(e.distinct(), A.alpha_by_day(p, b), "left")
    return {(r.ticker, r.event_date): r.alpha for r in joined.collect()}


@pytest.mark.parametrize("prices, event, expected", [
    ([(1, 10.0), (2, 11.0), (3, 12.0)], 0, 0.2),            # exactly three
    ([(1, 10.0), (2, 11.0)], 0, None),                      # two only
    ([(0, 5.0), (1, 10.0), (2, 11.0), (3, 12.0)], 0, 0.2),  # the event day is left out
    ([(1, 10.0), (2, 11.0), (34, 15.0)], 0, 0.5),           # third at day 34
    ([(1, 10.0), (2, 11.0), (35, 15.0)], 0, None),          # third at day 35
    ([(1, 0.0), (2, 11.0), (3, 15.0)], 0, None),            # zero start
    ([(1, 10.0), (2, None), (3, 15.0), (4, 20.0)], 0, 1.0), # null close skipped
])
def test_edges(spark, prices, event, expected):
    rows = [("T", day(n), c) for n, c in prices]
    bench = {day(n): 1.0 for n in range(40)}
    got = alphas(spark, rows, bench, [("T", day(event))])
    assert got[("T", day(event))] == (None if expected is None else pytest.approx(expected))


def test_random_series_against_the_definition(spark):
    rng = random.Random(7)
    prices, bench = [], {}
    for n in range(200):
        if rng.random() < 0.7:
            bench[day(n)] = rng.choice([1.0, 2.0, 3.0, 0.0, None])
        for t in "ABC":
            if rng.random() < {"A": 0.8, "B": 0.1, "C": 0.4}[t]:
                prices.append((t, day(n), rng.choice([1.0, 4.0, 5.0, 0.0, None])))
    events = [(t, day(n)) for t in "ABCD" for n in range(-40, 230)]
    got = alphas(spark, prices, bench, events)
    for key in events:
        want = brute(prices, bench, *key)
        assert got[key] == (None if want is None else pytest.approx(want)), key


def test_days_of_a_ticker_never_overlap(spark):
    rows = [("T", day(n), float(n % 5 + 1)) for n in range(0, 300, 3)]
    bench = {day(n): 1.0 for n in range(400)}
    p = spark.createDataFrame(rows, "ticker string, date date, close double")
    b = spark.createDataFrame(list(bench.items()), "date date, close double")
    by_day = A.alpha_by_day(p, b)
    assert by_day.count() == by_day.select("ticker", "event_date").distinct().count()


def test_events_are_joined_by_equality(spark, sf_dir):
    from tickerloom.catalog.alpha import forward_alpha

    plan = forward_alpha(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "HashJoin [ticker" in plan or "SortMergeJoin [ticker" in plan
