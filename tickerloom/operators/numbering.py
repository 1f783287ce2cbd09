"""Dense row numbers over a whole data set without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.session import shared_dir

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row below


def global_row_number(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number rows 1..n in ``order``, which should be unique per row.

    Rows are range-partitioned, sorted inside the partitions and checkpointed:
    range bounds come from a sample, so both reads below have to see the same
    written partitions, also after an executor is lost. A row's number is its
    place in the partition plus the rows of the partitions before. Only these
    counts, one per partition, pass through the driver and are broadcast.
    """
    shared_dir(df.sparkSession)
    placed = (
        df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
        .withColumn("__id", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftright("__id", _ROW_BITS))
    )
    counts = {r["__part"]: r["n"] for r in
              placed.groupBy("__part").agg(F.count("*").alias("n")).collect()}
    parts = sorted(counts)
    before = accumulate((counts[p] for p in parts), initial=0)
    offsets = df.sparkSession.createDataFrame(
        list(zip(parts, before)), "__part long, __offset long")
    place = F.col("__id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + place + 1)
        .drop("__id", "__part", "__offset")
    )
