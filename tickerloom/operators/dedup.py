"""Duplicate rows, per file, with unlabelled rows kept."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.labels import is_missing_label
from tickerloom.functions.naming import col


def dedup_rows(df: DataFrame) -> DataFrame:
    """Distinct rows. A file key in the row keeps copies in two files apart.

    Copies collapse in the map-side aggregation, so a row repeated a billion
    times costs one shuffled row per task.
    """
    return df.dropDuplicates()


def any_label_missing(targets: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [is_missing_label(col(t)) for t in targets])


def dedup_keep_unlabelled(df: DataFrame, targets: Sequence[str],
                          place: str | None = None) -> DataFrame:
    """Distinct among fully labelled rows; rows missing a label all stay.

    The unlabelled rows, mostly the larger part, are not shuffled. The label
    test is pushed below the row's own projections on both branches, so text is
    normalised once per row even though the source is scanned twice. With
    ``place``, a column of row places that no comparison looks at, the first of
    equal rows stays.
    """
    def distinct(rows: DataFrame) -> DataFrame:
        if place is None:
            return dedup_rows(rows)
        others = [col(c) for c in df.columns if c != place]
        return rows.groupBy(*others).agg(F.min(place).alias(place)).select(
            *[col(c) for c in df.columns])

    if not targets:
        return distinct(df)
    missing = any_label_missing(targets)
    return distinct(df.where(~missing)).unionByName(df.where(missing))
