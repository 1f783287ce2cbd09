"""Date queries. Order dates are rendered to text first, by order priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.catalog.tables import iso, table
from tickerloom.functions import dates as D
from tickerloom.operators import aggregates
from tickerloom.operators.alpha import window_bounds

# priority -> (Spark pattern, strftime pattern)
STYLES = {
    "1-URGENT": ("dd-MM-yyyy", "%d-%m-%Y"),
    "2-HIGH": ("MM/dd/yyyy", "%m/%d/%Y"),
    "3-MEDIUM": ("yyyy-MM-dd'T'HH:mm:ss'+05:30'", "%Y-%m-%dT%H:%M:%S+05:30"),
    "4-NOT SPECIFIED": ("MMMM d, yyyy, EEEE", "%B %-d, %Y, %A"),
    "5-LOW": ("d MMM yyyy HH:mm 'GMT'", "%-d %b %Y %H:%M GMT"),
}


def rendered(spark: SparkSession, sf: str) -> DataFrame:
    text: Column = F.lit("not a date")
    for priority, (pattern, _) in STYLES.items():
        text = F.when(F.col("o_orderpriority") == priority,
                      F.date_format("o_orderdate", pattern)).otherwise(text)
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.when(F.col("o_orderstatus") == "P", F.lit("foo")).otherwise(text).alias("raw"))


def parse_dates_mixed(spark: SparkSession, sf: str) -> DataFrame:
    return D.parse_mixed(rendered(spark, sf), "raw", "ts").select(
        "o_orderkey", "raw", D.to_iso_utc(F.col("ts")).alias("ts"))


def parse_dates_gap_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Year-day-month text, which only the second, free-form reading can tell."""
    source = rendered(spark, sf).join(table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-dd-MM").alias("swapped")), "o_orderkey")
    source = source.select("o_orderkey", F.when(F.col("raw") == "foo", F.col("swapped"))
                           .otherwise(F.col("raw")).alias("raw"))
    return D.parse_mixed(source, "raw", "ts", gap_fill=True).select(
        "o_orderkey", "raw", D.to_iso_utc(F.col("ts")).alias("ts"))


def parse_dates_dayfirst(spark: SparkSession, sf: str) -> DataFrame:
    return D.parse_mixed(rendered(spark, sf), "raw", "ts", day_first=True).select(
        "o_orderkey", "raw", D.to_iso_utc(F.col("ts")).alias("ts"))


def parse_dates_complex(spark: SparkSession, sf: str) -> DataFrame:
    source = table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "MMMM d, yyyy, EEEE").alias("raw"))
    return D.parse_complex(source, "raw", "ts").select(
        "o_orderkey", "raw", D.to_iso_utc(F.col("ts")).alias("ts"))


def parse_dates_exact(spark: SparkSession, sf: str) -> DataFrame:
    pattern = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.coalesce(pattern, F.date_format("o_orderdate", "yyyyMMdd")).alias("raw"),
    ).select("o_orderkey", "raw", D.to_iso_utc(D.parse_exact(F.col("raw"))).alias("ts"))


def event_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar date as shown, and the price window around it."""
    source = table(spark, sf, "orders").select("o_orderkey", F.concat(
        F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T23:30:00-05:00")).alias("raw"))
    low, high = window_bounds(F.col("d"))
    return D.to_event_date(source, "raw", "d").select(
        "o_orderkey", iso(F.col("d")).alias("event_date"),
        iso(low).alias("from_date"), iso(high).alias("to_date"),
        iso(D.floor_to_day(F.to_timestamp("raw"))).alias("utc_day"))


def date_parse_rate(spark: SparkSession, sf: str) -> DataFrame:
    parsed = D.parse_mixed(rendered(spark, sf), "raw", "ts")
    return aggregates.date_parse_rate(parsed, "raw", "ts", ["o_orderstatus"])


QUERIES = {
    "parse_dates_mixed": parse_dates_mixed,
    "parse_dates_gap_fill": parse_dates_gap_fill,
    "parse_dates_dayfirst": parse_dates_dayfirst,
    "parse_dates_complex": parse_dates_complex,
    "parse_dates_exact": parse_dates_exact,
    "event_dates": event_dates,
    "date_parse_rate": date_parse_rate,
}

_CASES = " ".join(f"WHEN '{p}' THEN strftime(o_orderdate, '{f}')" for p, (_, f) in STYLES.items())
_RENDERED = f"""
rendered AS (
  SELECT o_orderkey, o_orderstatus,
         CASE WHEN o_orderstatus = 'P' THEN 'foo'
              ELSE CASE o_orderpriority {_CASES} ELSE 'not a date' END END AS raw
  FROM orders)"""


def _parsed(month_first: bool) -> str:
    formats = ["%d-%m-%Y", "%m-%d-%Y", "%d/%m/%Y", "%m/%d/%Y"]
    if month_first:
        formats = ["%m-%d-%Y", "%d-%m-%Y", "%m/%d/%Y", "%d/%m/%Y"]
    formats += ["%B %d, %Y, %A", "%d %b %Y %H:%M GMT"]
    tries = ", ".join(f"try_strptime(raw, '{f}')" for f in formats)
    shifted = ("try_strptime(replace(raw, '+05:30', ''), '%Y-%m-%dT%H:%M:%S') "
               "- INTERVAL 330 MINUTE")
    return f"coalesce({tries}, {shifted})"


_OUT = "strftime({}, '%Y-%m-%d %H:%M:%S')"

ORACLES = {
    "parse_dates_mixed": f"""WITH {_RENDERED}
SELECT o_orderkey, raw, {_OUT.format(_parsed(True))} AS ts FROM rendered""",
    "parse_dates_gap_fill": f"""WITH {_RENDERED}, swapped AS (
  SELECT o_orderkey, CASE WHEN raw = 'foo' THEN strftime(o_orderdate, '%Y-%d-%m')
                          ELSE raw END AS raw
  FROM rendered JOIN orders USING (o_orderkey))
SELECT o_orderkey, raw, {_OUT.format("coalesce(" + _parsed(True)
    + ", try_strptime(raw, '%Y-%m-%d'), try_strptime(raw, '%Y-%d-%m'))")} AS ts FROM swapped""",
    "parse_dates_dayfirst": f"""WITH {_RENDERED}
SELECT o_orderkey, raw, {_OUT.format(_parsed(False))} AS ts FROM rendered""",
    "parse_dates_complex": f"""
WITH r AS (SELECT o_orderkey, strftime(o_orderdate, '%B %-d, %Y, %A') AS raw FROM orders)
SELECT o_orderkey, raw, {_OUT.format("try_strptime(raw, '%B %d, %Y, %A')")} AS ts FROM r""",
    "parse_dates_exact": f"""
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P'
    THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y%m%d') END AS raw
  FROM orders)
SELECT o_orderkey, raw, {_OUT.format("try_strptime(raw, '%Y%m%d')")} AS ts FROM r""",
    "event_dates": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS event_date,
       strftime(o_orderdate - INTERVAL 10 DAY, '%Y-%m-%d') AS from_date,
       strftime(o_orderdate + INTERVAL 35 DAY, '%Y-%m-%d') AS to_date,
       strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS utc_day
FROM orders""",
    "date_parse_rate": f"""WITH {_RENDERED}, parsed AS (
  SELECT o_orderstatus, raw, {_parsed(True)} AS ts FROM rendered)
SELECT o_orderstatus, count(*) AS n_rows, count(ts) AS n_parsed,
       count(*) FILTER (raw IS NOT NULL AND ts IS NULL) AS n_coerced,
       avg(CAST(ts IS NOT NULL AS INTEGER)) * 100 AS valid_pct,
       avg(CAST(ts IS NOT NULL AS INTEGER)) * 100 < 50 AS low_rate
FROM parsed GROUP BY 1""",
}
