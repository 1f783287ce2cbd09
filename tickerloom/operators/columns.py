"""Projections: renames, drops, symbols, text choice, wide-to-long."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.naming import col
from tickerloom.functions.text import trim_ws

# --- fixed values -----------------------------------------------------------
UNNAMED = r"^(Unnamed:.*|_c\d+)$"
CANONICAL_NAMES = {
    "label": "sentiment",
    "publish_date": "date",
    "publish date": "date",
}
SYMBOL_FOLDER = "nifty 50"
SYMBOL_COLUMN = "Symbol"
MIN_FULL_TEXT = 300
UNKNOWN_PUBLISHER = "Unknown Source"
# ----------------------------------------------------------------------------


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename what is there; absent names are ignored. Exact case."""
    return _renamed(df, [names.get(c, c) for c in df.columns])


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    gone = set(names)
    return df.select(*[col(c) for c in df.columns if c not in gone])


def drop_unnamed(df: DataFrame) -> DataFrame:
    import re

    return df.select(*[col(c) for c in df.columns if not re.match(UNNAMED, c)])


def canonical_names(df: DataFrame) -> DataFrame:
    """Label and publish-date columns under their common names."""
    return _renamed(df, [CANONICAL_NAMES.get(c.strip().lower(), c) for c in df.columns])


def _renamed(df: DataFrame, names: list[str]) -> DataFrame:
    twice = {n for n in names if names.count(n) > 1}
    if twice:
        raise ValueError(f"columns would share a name: {sorted(twice)}")
    return df.toDF(*names)


def file_stem(file_name: Column) -> Column:
    return F.regexp_replace(file_name, r"(?<=.)\.[^.]*$", "")


def inject_symbol(df: DataFrame, path: Column) -> DataFrame:
    """The file stem as ``Symbol`` for files below the index folder.

    Rows of other files get null, a frame that has the column is left alone.
    """
    if SYMBOL_COLUMN in df.columns:
        return df
    below = F.lower(path).contains(f"/{SYMBOL_FOLDER}/")
    stem = file_stem(F.substring_index(path, "/", -1))
    return df.withColumn(SYMBOL_COLUMN, F.when(below, stem))


def truncate(c: Column, n: int | None = None) -> Column:
    """The first ``n`` characters (code points); all of them unless ``n`` is given."""
    return c if n is None else F.substring(c, 1, n)


def publisher_title(title: Column) -> Column:
    return F.coalesce(title, F.lit(UNKNOWN_PUBLISHER))


def choose_text(title: Column, publisher: Column, description: Column,
                full_text: Column) -> Column:
    """The trimmed full text when it is substantial, else the summary line."""
    summary = F.concat_ws(" | ", *[F.coalesce(c, F.lit("")) for c in
                                   (title, publisher, description)])
    full = trim_ws(full_text)
    return F.when(F.length(full) > MIN_FULL_TEXT, full).otherwise(summary)


def unpivot_headlines(df: DataFrame, date_column: str | None) -> DataFrame:
    """Wide to long: every other column becomes a ``text`` row, nulls dropped."""
    values = [c for c in df.columns if c != date_column]
    wide = df.select(*([col(date_column).alias("date")] if date_column else []),
                     *[col(c).cast("string").alias(c) for c in values])
    ids = ["date"] if date_column else []
    long = wide.unpivot(ids, [col(c) for c in values], "__src", "text")
    return long.where("text is not null").drop("__src")
