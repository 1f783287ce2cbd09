"""Input tables that stand where network clients would be: prices and news."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickerloom.functions.dates import to_event_date
from tickerloom.operators.columns import publisher_title

NEWS_COLUMNS = ["url", "event_date", "title", "description", "publisher", "full_text"]


def prices_table(raw: DataFrame, ticker: str = "ticker", when: str = "ts",
                 close: str = "close") -> DataFrame:
    """(ticker, date, close): null closes dropped, timestamps floored to the day.

    A day with several rows keeps its last close, so that a series never has
    more rows than the calendar has days.
    """
    present = raw.where(F.col(close).isNotNull()).select(
        F.col(ticker).alias("ticker"), F.col(when).alias("__ts"),
        F.col(close).cast("double").alias("close"))
    return present.groupBy("ticker", F.to_date("__ts").alias("date")).agg(
        F.max_by("close", F.struct("__ts", "close")).alias("close"))


def news_table(raw: DataFrame, published: str = "published") -> DataFrame:
    """Article rows with a flat publisher and a calendar date.

    ``publisher`` may be a struct with a ``title`` or a plain string; a missing
    struct field falls back to a fixed name, a missing full text to null.
    """
    out = raw
    kind = raw.schema["publisher"].dataType if "publisher" in raw.columns else None
    if isinstance(kind, StructType):
        out = out.withColumn("publisher", publisher_title(F.col("publisher.title")))
    for name in ("title", "description", "publisher", "full_text"):
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None).cast("string"))
    return to_event_date(out, published, "event_date")
