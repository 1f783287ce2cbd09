"""Alpha queries. Suppliers stand for tickers, order dates for news dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.catalog.tables import iso, table
from tickerloom.functions.labels import binary_alpha_label
from tickerloom.operators import alpha as A


def prices(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("ticker"), F.col("l_shipdate").cast("date").alias("date"),
        "l_extendedprice", "l_quantity")
    return A.daily_close(lines, ["ticker", "date"],
                         F.try_divide("l_extendedprice", "l_quantity"))


def benchmark(spark: SparkSession, sf: str) -> DataFrame:
    return A.daily_close(prices(spark, sf), ["date"], F.col("close"))


def alpha_days(spark: SparkSession, sf: str) -> DataFrame:
    return A.alpha_by_day(prices(spark, sf), benchmark(spark, sf))


def events(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("event_date"))
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("ticker"))
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).drop("o_orderkey")


def forward_alpha(spark: SparkSession, sf: str) -> DataFrame:
    joined = A.next_trading_day_join(events(spark, sf), alpha_days(spark, sf))
    return joined.select(
        "l_orderkey", "l_linenumber", "ticker", iso(F.col("event_date")).alias("event_date"),
        "alpha",
        binary_alpha_label(F.col("alpha")).alias("label"))


def benchmark_align(spark: SparkSession, sf: str) -> DataFrame:
    aligned = A.align_to_benchmark(prices(spark, sf), benchmark(spark, sf))
    return aligned.select("ticker", iso(F.col("date")).alias("date"),
                          "close",
                          "bench_close")


def forward_returns(spark: SparkSession, sf: str) -> DataFrame:
    aligned = A.align_to_benchmark(prices(spark, sf), benchmark(spark, sf))
    return A.forward_return(aligned).select(
        "ticker", iso(F.col("start_date")).alias("start_date"),
        iso(F.col("end_date")).alias("end_date"),
        "stock_return",
        "bench_return",
        A.alpha().alias("alpha"))


def alpha_label_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Events per ticker and label; every ticker is reported, zeros too.

    Events shrink to one row per (ticker, day) before they meet the alphas.
    """
    every = events(spark, sf)
    per_day = every.groupBy("ticker", "event_date").agg(F.count("*").alias("n"))
    labelled = A.next_trading_day_join(per_day, alpha_days(spark, sf), "left")
    label = binary_alpha_label(F.col("alpha"))
    return labelled.groupBy("ticker").agg(
        F.sum("n").alias("n_events"),
        F.coalesce(F.sum(F.when(label == 1, F.col("n"))), F.lit(0)).alias("n_up"),
        F.coalesce(F.sum(F.when(label == 0, F.col("n"))), F.lit(0)).alias("n_down"))


def recent_prices(spark: SparkSession, sf: str) -> DataFrame:
    """The closes of each ticker's last seven days."""
    return A.recent_window(prices(spark, sf)).select("ticker", iso(F.col("date")).alias("date"),
                                                     "close")


QUERIES = {
    "recent_prices": recent_prices,
    "forward_alpha": forward_alpha,
    "benchmark_align": benchmark_align,
    "forward_return": forward_returns,
    "alpha_label_counts": alpha_label_counts,
}

_PRICES = """
prices AS (
  SELECT l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS date,
         max(l_extendedprice / nullif(l_quantity, 0)) AS close
  FROM lineitem GROUP BY 1, 2
  HAVING max(l_extendedprice / nullif(l_quantity, 0)) IS NOT NULL),
bench AS (SELECT date, max(close) AS close FROM prices GROUP BY 1),
aligned AS (
  SELECT p.ticker, p.date, p.close, b.close AS bench_close
  FROM prices p JOIN bench b ON p.date = b.date),
fwd AS (
  SELECT ticker, date, close, bench_close,
         lead(date, 2) OVER w AS end_date,
         lead(close, 2) OVER w AS s_end,
         lead(bench_close, 2) OVER w AS b_end
  FROM aligned WINDOW w AS (PARTITION BY ticker ORDER BY date))"""

_EVENTS = """
events AS (
  SELECT l_orderkey, l_linenumber, l_suppkey AS ticker,
         CAST(o_orderdate AS DATE) AS event_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
matched AS (
  SELECT e.*, CASE WHEN f.end_date < e.event_date + INTERVAL 35 DAY
                    AND f.close > 0 AND f.bench_close > 0
              THEN (f.s_end - f.close) / f.close
                 - (f.b_end - f.bench_close) / f.bench_close END AS alpha
  FROM events e ASOF LEFT JOIN fwd f
    ON e.ticker = f.ticker AND e.event_date < f.date)"""

ORACLES = {
    "recent_prices": f"""WITH {_PRICES}
SELECT ticker, strftime(date, '%Y-%m-%d') AS date, close FROM prices
QUALIFY date > max(date) OVER (PARTITION BY ticker) - INTERVAL 7 DAY""",
    "forward_alpha": f"""WITH {_PRICES}, {_EVENTS}
SELECT l_orderkey, l_linenumber, ticker, strftime(event_date, '%Y-%m-%d') AS event_date,
       alpha, CAST(alpha > 0 AS INTEGER) AS label
FROM matched WHERE alpha IS NOT NULL""",
    "benchmark_align": f"""WITH {_PRICES}
SELECT ticker, strftime(date, '%Y-%m-%d') AS date, close, bench_close
FROM aligned""",
    "forward_return": f"""WITH {_PRICES}
SELECT ticker, strftime(date, '%Y-%m-%d') AS start_date,
       strftime(end_date, '%Y-%m-%d') AS end_date,
       (s_end - close) / close AS stock_return,
       (b_end - bench_close) / bench_close AS bench_return,
       (s_end - close) / close - (b_end - bench_close) / bench_close AS alpha
FROM fwd WHERE end_date IS NOT NULL AND close > 0 AND bench_close > 0""",
    "alpha_label_counts": f"""WITH {_PRICES}, {_EVENTS}
SELECT ticker, count(*) AS n_events, count(*) FILTER (alpha > 0) AS n_up,
       count(*) FILTER (alpha <= 0) AS n_down
FROM matched GROUP BY ticker""",
}
