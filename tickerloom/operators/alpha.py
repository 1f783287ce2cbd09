"""Forward returns after an event, relative to a benchmark.

The usual as-of plan (events and prices in one window per ticker) sorts all
events of a ticker in one task, so a ticker holding a third of the events would
stall it. Here only the price series go through a window: after the
one-row-per-day aggregation a ticker has at most one row per calendar day,
however many events it has. Each start price is then expanded to the calendar
days whose next trading day it is. Those day ranges are disjoint and at most
``horizon`` long, and events meet them in a plain equi-join on (ticker, date),
which adaptive execution splits when a ticker is hot.
"""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
TRADING_DAYS = 3      # closes taken after the event
LOOKAHEAD_DAYS = 35   # closes must be dated before event + 35 days
LOOKBACK_DAYS = 10
RECENT_DAYS = 7       # of the latest prices
# ----------------------------------------------------------------------------


def daily_close(prices: DataFrame, keys: list[str], close: Column) -> DataFrame:
    """One close per key and day, the largest of the non-null ones.

    Null keys are dropped here, so that every use of the same series has the
    same plan and Spark reuses one shuffle for all of them.
    """
    present = prices.where(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    return present.groupBy(*keys).agg(F.max(close).alias("close")).where("close is not null")


def window_bounds(event_date: Column) -> tuple[Column, Column]:
    """The [from, to) range of price dates an event may look at."""
    return (F.date_sub(event_date, LOOKBACK_DAYS), F.date_add(event_date, LOOKAHEAD_DAYS))


def align_to_benchmark(prices: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Keep the dates both series have; adds ``bench_close``.

    The benchmark is grouped to one row per calendar day, so its size is
    bounded by the calendar (some 250 rows a year), not by the data. That bound
    is what makes the broadcast safe.
    """
    daily = benchmark.groupBy("date").agg(F.max("close").alias("bench_close"))
    daily = daily.where("bench_close is not null")
    return prices.where("close is not null").join(F.broadcast(daily), "date")


def forward_return(aligned: DataFrame, k: int = TRADING_DAYS) -> DataFrame:
    """Per ticker and start date: returns from that close to the ``k``-th one.

    ``prev_date`` is the common date before, ``end_date`` the ``k``-th date.
    Rows without ``k`` closes or with a start price that is not positive are
    dropped after the previous date was taken, as they still end the range of
    the row before.
    """
    by_day = Window.partitionBy("ticker").orderBy("date")
    return (
        aligned.select(
            "ticker", F.col("date").alias("start_date"),
            F.lag("date").over(by_day).alias("prev_date"),
            F.lead("date", k - 1).over(by_day).alias("end_date"),
            F.col("close").alias("s_start"),
            F.lead("close", k - 1).over(by_day).alias("s_end"),
            F.col("bench_close").alias("b_start"),
            F.lead("bench_close", k - 1).over(by_day).alias("b_end"),
        )
        .where("end_date is not null and s_start > 0 and b_start > 0")
        .select(
            "ticker", "start_date", "prev_date", "end_date",
            ((F.col("s_end") - F.col("s_start")) / F.col("s_start")).alias("stock_return"),
            ((F.col("b_end") - F.col("b_start")) / F.col("b_start")).alias("bench_return"),
        )
    )


def alpha() -> Column:
    return F.col("stock_return") - F.col("bench_return")


def alpha_by_day(prices: DataFrame, benchmark: DataFrame, k: int = TRADING_DAYS,
                 horizon: int = LOOKAHEAD_DAYS) -> DataFrame:
    """(ticker, event_date, alpha) for every calendar day that has an alpha.

    A start date serves the days from the previous common date to the day
    before it, as far as its ``k``-th date lies within the horizon.
    """
    returns = forward_return(align_to_benchmark(prices, benchmark), k)
    earliest = F.greatest(F.coalesce("prev_date", F.date_sub("end_date", horizon)),
                          F.date_sub("end_date", horizon - 1))
    latest = F.date_sub("start_date", 1)
    return (
        returns.select("ticker", alpha().alias("alpha"),
                       earliest.alias("first_day"), latest.alias("last_day"))
        .where("first_day <= last_day")
        .select("ticker", F.explode(F.sequence("first_day", "last_day")).alias("event_date"),
                "alpha")
    )


def next_trading_day_join(events: DataFrame, by_day: DataFrame,
                          how: str = "inner") -> DataFrame:
    """Attach the forward alpha to events on (ticker, event_date).

    An inner join drops events without a label. Adaptive execution chooses the
    join by the sizes it measures.
    """
    return events.join(by_day, ["ticker", "event_date"], how)


def recent_window(prices: DataFrame, days: int = RECENT_DAYS, *,
                  as_of: date | None = None) -> DataFrame:
    """The prices of each ticker's last ``days`` calendar days.

    They end at ``as_of``, where the range is a plain filter that reaches the scan,
    or else at the ticker's own latest date: one partial maximum per ticker, joined
    back by equality. A ticker without any date has no row.
    """
    if as_of is not None:
        end = F.lit(as_of)
        return prices.where((F.col("date") > F.date_sub(end, days)) & (F.col("date") <= end))
    latest = prices.groupBy("ticker").agg(F.max("date").alias("__latest"))
    return prices.join(latest, "ticker").where(
        F.col("date") > F.date_sub("__latest", days)).select(*prices.columns)
