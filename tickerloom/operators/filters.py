"""Row predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.labels import is_well_formed_block
from tickerloom.functions.naming import col
from tickerloom.functions.text import is_blank

# --- fixed values -----------------------------------------------------------
MIN_NEWS_CHARS = 50
# ----------------------------------------------------------------------------


def non_blank(df: DataFrame, column: str) -> DataFrame:
    return df.where(~is_blank(col(column)))


def valid_url(url: Column) -> Column:
    return F.coalesce(url != "", F.lit(False))


def valid_news(df: DataFrame, url: str = "url", date: str = "event_date") -> DataFrame:
    return df.where(valid_url(col(url)) & col(date).isNotNull())


def min_length(df: DataFrame, column: str, n: int = MIN_NEWS_CHARS) -> DataFrame:
    """Longer than ``n`` characters."""
    return df.where(F.length(col(column)) > n)


def label_available(df: DataFrame, column: str = "alpha") -> DataFrame:
    return df.where(col(column).isNotNull())


def well_formed(df: DataFrame, column: str = "output") -> DataFrame:
    return df.where(is_well_formed_block(col(column)))


def drop_null_text(df: DataFrame, column: str = "text") -> DataFrame:
    return df.dropna(subset=[column])
