"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame

TREE_KEYS = ("schema_group", "source_folder", "source_file")


def write_parquet_tree(df: DataFrame, root: str, mode: str = "append",
                       keys: tuple[str, ...] = TREE_KEYS) -> None:
    """One folder per input file under its folder's name.

    Rows are brought together per file first, or every task would leave a small
    file in every folder; the rebalance splits a file that holds most rows.
    """
    df.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).parquet(root)


def write_ordered_tree(df: DataFrame, root: str, place: str,
                       keys: tuple[str, ...] = TREE_KEYS[1:]) -> None:
    """As ``write_parquet_tree``, with the rows of a source in the order of ``place``.

    Rows are split by ranges of (keys, place) and sorted within the ranges, so the
    part files of a folder, taken by name, hold them in order; ``place`` itself is not
    written. A large source spreads over many ranges.
    """
    order = [*keys, place]
    df.repartitionByRange(*order).sortWithinPartitions(*order).drop(place).write.mode(
        "append").partitionBy(*keys).parquet(root)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("ignoreNullFields", False).json(path)


def overwrite_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.write.mode("overwrite").parquet(path)


def append_manifest(rows: DataFrame, path: str) -> None:
    """Add the outcomes of some files to a manifest that nobody reads yet."""
    rows.write.mode("append").parquet(path)


def append_checkpoint(keys: DataFrame, path: str) -> None:
    """Record finished keys; call after their rows are written."""
    keys.select(keys[keys.columns[0]].cast("string")).write.mode("append").text(path)


def overwrite_checkpoint(keys: DataFrame, path: str) -> None:
    """Record the keys of one run; repeating it leaves one copy."""
    keys.select(keys[keys.columns[0]].cast("string")).write.mode("overwrite").text(path)
