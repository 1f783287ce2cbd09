"""First-n rows per group that survive a group holding much of the data.

A filter on ``row_number()`` makes Spark keep only the first ``k`` rows per
group on the map side. Large inputs have many map tasks, so the survivors of a
hot group are ranked in two rounds: first per (group, salt), then per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
RESULTS_PER_SEARCH = 50
# ----------------------------------------------------------------------------

SALTS = 32


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                    k: int, rank: str = "rank", salt_on: Sequence[str] | None = None,
                    salts: int = SALTS) -> DataFrame:
    """The first ``k`` rows per group under ``order``, with their rank.

    ``order`` has to be total within a group for a repeatable result.
    ``salt_on`` names columns that spread the rows of one group; the salt is a
    hash of them, so a recomputed task sends its rows to the same place.
    """
    spread = list(salt_on) if salt_on else [c for c in df.columns if c not in keys]
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
    local = Window.partitionBy(*keys, "__salt").orderBy(*order)
    final = Window.partitionBy(*keys).orderBy(*order)
    return (
        salted.withColumn("__local", F.row_number().over(local))
        .where(F.col("__local") <= k).drop("__local", "__salt")
        .withColumn(rank, F.row_number().over(final))
        .where(F.col(rank) <= k)
    )


def first_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first copy per key; apply before tests that may reject that copy.

    ``order`` names columns that rank the copies, smallest first. One aggregate
    with partial minima: a hot key is reduced before the one shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("__first"))
    return first.select(*keys, "__first.*").select(*df.columns)


def best_score(df: DataFrame, score: str, name: str) -> DataFrame:
    """The top row by score, ties by name."""
    return df.orderBy(F.desc(score), F.asc(name)).limit(1)
