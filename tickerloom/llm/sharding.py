"""Minimax contiguous partition of texts into shards of nearly equal size.

Texts are dealt to 65,536 ordered cells by a digest; copies of a text share a
cell, so cells are the ordered atomic groups. The smallest feasible capacity is
found by binary search, each guess checked greedily, all in one aggregate over
the cells' sizes (a table whose size does not depend on the data). Then the cells
are cut: a shard closes at its fair share of what is left, within the capacity
and where the rest still fits the remaining shards. Rows find their shard by
their cell, and slots are numbered over a range-partitioned sort.

Defined results: a null text is empty (size 8, checksum 0) and lies with the empty
ones; repeated rows get slots of their own; an empty table gives no rows; input
columns named like result columns give way.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm.common import arrow_ready, table, without
from tickerloom.operators.numbering import global_row_number

SHARDS = 24
CELL_DIGITS = 4  # hexadecimal digits of the digest
RESULTS = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def smallest_capacity(cells: str, shards: int) -> str:
    """SQL: the smallest capacity at which the greedy cut needs at most ``shards``.

    ``cells`` is an array of structs with a ``size``, in order.
    """
    need = (f"aggregate({cells}, named_struct('n', 1, 'load', 0L), (a, x) -> "
            "if(a.load + x.size <= {c}, named_struct('n', a.n, 'load', a.load + x.size), "
            "named_struct('n', a.n + 1, 'load', x.size)), a -> a.n)")
    middle = "s.low + (s.high - s.low) div 2"
    step = f"if({need.format(c=middle)} <= {shards}, " \
           f"named_struct('low', s.low, 'high', {middle}), " \
           f"named_struct('low', {middle} + 1L, 'high', s.high))"
    total = f"aggregate({cells}, 0L, (a, x) -> a + x.size)"
    largest = f"aggregate({cells}, 0L, (a, x) -> greatest(a, x.size))"
    return (f"aggregate(sequence(1, 63), named_struct('low', {largest}, 'high', {total}), "
            f"(s, i) -> if(s.low >= s.high, s, {step}), s -> s.low)")


def cut_cells(sizes: DataFrame, shards: int) -> DataFrame:
    """One row per shard: its first cell, from (cell, size, n) rows of bounded number."""
    one = sizes.agg(F.sort_array(F.collect_list(F.struct("cell", "size", "n"))).alias("cells"))
    one = one.withColumn("cap", F.expr(smallest_capacity("cells", shards)))
    # From the right: the place from which k shards of that capacity hold the rest.
    one = one.withColumn("fits", F.expr(
        "aggregate(reverse(cells), named_struct('load', 0L, 'at', size(cells), "
        "'cuts', array(size(cells))), (a, x) -> if(a.load + x.size <= cap, "
        "named_struct('load', a.load + x.size, 'at', a.at - 1, 'cuts', a.cuts), "
        "named_struct('load', x.size, 'at', a.at - 1, 'cuts', array_append(a.cuts, a.at))), "
        "a -> array_append(a.cuts, 0))"))
    one = one.withColumn("total", F.expr("aggregate(cells, 0L, (a, x) -> a + x.size)"))
    left = f"({shards} - size(a.firsts))"
    close = (f"a.load > 0 and {left} > 0 and (a.load + x.size > cap or ("
             f"a.at >= if({left} < size(fits), fits[{left}], 0) and "
             f"(2 * a.load + x.size) * ({left} + 1) > 2 * a.rest))")
    one = one.withColumn("firsts", F.expr(
        "aggregate(cells, named_struct('load', 0L, 'at', 0, 'rest', total, "
        "'firsts', array(-1L)), (a, x) -> "
        f"if({close}, named_struct('load', x.size, 'at', a.at + 1, 'rest', a.rest - a.load, "
        "'firsts', array_append(a.firsts, x.cell)), named_struct('load', a.load + x.size, "
        "'at', a.at + 1, 'rest', a.rest, 'firsts', a.firsts)), a -> a.firsts)"))
    return one.select("cells", "firsts")


def shard_by_bytes(df: DataFrame, id: str = "doc_id", text: str = "text",
                   shards: int = SHARDS, keep: Iterable[str] | None = None) -> DataFrame:
    """``keep`` (all but the text) and size, text_crc32, law, shard, slot, grown_shard."""
    arrow_ready(df.sparkSession)
    keep = without(df, [text, *RESULTS]).columns if keep is None else list(keep)
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    sized = df.select(
        *[F.col(f"`{c}`") for c in keep],
        (F.octet_length(content) + 8).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.conv(F.substring(F.md5(content), 1, CELL_DIGITS), 16, 10).cast("long").alias("cell")
    ).checkpoint()
    sizes = sized.groupBy("cell").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    cut = cut_cells(sizes, shards).select("firsts", F.expr(
        "transform(firsts, f -> aggregate(cells, 0L, (a, x) -> a + if(x.cell < f, x.n, 0L)))")
        .alias("rows_before")).first()
    firsts, rows_before = (F.array(*map(F.lit, some)) for some in cut)  # one number a shard
    order = [F.col("cell"), F.col("text_crc32")] + ([F.col(f"`{id}`")] if id in keep else [])
    numbered = global_row_number(sized, order, "__number")
    return numbered.withColumn("shard", (F.size(F.filter(
        firsts, lambda first: first <= F.col("cell"))) - 1).cast("int")).select(
        *[F.col(f"`{c}`") for c in keep], "size", "text_crc32", F.lit("bytes").alias("law"),
        "shard", (F.col("__number") - 1 - F.get(rows_before, F.col("shard"))).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"), keep=["doc_id"])


QUERIES = {"op4_sharding": op4_sharding}
ORACLES: dict[str, str] = {}
