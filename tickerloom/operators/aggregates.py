"""Counts and rates for manifests and progress reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.labels import as_number

# --- fixed values -----------------------------------------------------------
MIN_PARSE_PERCENT = 50.0
# ----------------------------------------------------------------------------


def rows_per(df: DataFrame, keys: Sequence[str], name: str = "rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def status_totals(manifest: DataFrame) -> DataFrame:
    return manifest.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "success").alias("success"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.coalesce(F.sum("rows_in"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum("rows_out"), F.lit(0)).alias("rows_out"))


def parse_counts(raw: Column, parsed: Column) -> dict[str, Column]:
    """Aggregates for one date column: rows, parsed, coerced, percent, warning."""
    percent = F.avg(parsed.isNotNull().cast("int")) * 100
    return {
        "n_rows": F.count("*"),
        "n_parsed": F.count(parsed),
        "n_coerced": F.count_if(raw.isNotNull() & parsed.isNull()),
        "valid_pct": percent,
        "low_rate": percent < MIN_PARSE_PERCENT,
    }


def date_parse_rate(df: DataFrame, raw: str, parsed: str,
                    keys: Sequence[str] = ()) -> DataFrame:
    counts = parse_counts(F.col(raw), F.col(parsed))
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in counts.items()])


def kept_per_group(groups: DataFrame, kept: DataFrame, keys: Sequence[str],
                   name: str = "saved") -> DataFrame:
    """Rows kept per group; groups that kept none are reported with zero.

    Rows shrink to one per group before the join.
    """
    counts = rows_per(kept, keys, name)
    return groups.join(counts, list(keys), "left").withColumn(
        name, F.coalesce(F.col(name), F.lit(0)))


def has_numeric(c: Column) -> Column:
    return F.count(as_number(c)) > 0
