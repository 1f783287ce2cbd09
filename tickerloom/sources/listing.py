"""Which files there are, and what their first lines and bytes say."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.session import shared_dir

# --- fixed values -----------------------------------------------------------
DATA_SUFFIXES = [".csv", ".tsv", ".txt", ".parquet", ".json", ".jsonl", ".xlsx", ".xls"]
SKIPPED_SUFFIXES = [".py", ".md", ".rst", ".sh", ".bat", ".ipynb"]
SKIPPED_NAMES = ["readme.txt", "license.txt", "licence.txt", "readme.md",
                 "changelog.txt", "requirements.txt"]
SNIFFED_SEPARATORS = [",", "\t", ";", "|"]
# ----------------------------------------------------------------------------


def suffix_of(name: Column) -> Column:
    """Lower-case suffix with its dot; empty for none (a leading dot is none)."""
    return F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))


def is_hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return (name.startswith(".") or (name.startswith("_") and "=" not in name)
            or name.endswith("._COPYING_"))


def qualified(spark: SparkSession, root: str) -> str:
    """The root with its scheme, as Spark names the files below it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return system.makeQualified(path).toString().rstrip("/")


def opened(path: str):
    """The pyarrow file system of a qualified path, and the path there."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    authority, _, inner = rest.lstrip("/").partition("/")
    scheme = "s3" if scheme in ("s3a", "s3n") else scheme
    system, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system, "/".join(p for p in (base.rstrip("/"), inner) if p) or "/"


def _children(batches: Iterator) -> Iterator:
    """Task: what lies in each folder, one batch per 4,096 entries."""
    import pyarrow as pa
    from pyarrow import fs

    def sent(rows: list):
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([
            pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
            pa.array(columns[2], pa.bool_()), pa.array(columns[3], pa.bool_())],
            names=["path", "length", "hidden", "is_folder"])

    for batch in batches:
        for folder, hidden in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            system, inner = opened(folder)
            rows = []
            for info in system.get_file_info(fs.FileSelector(inner)):
                inside = info.type == fs.FileType.Directory
                if inside or info.type == fs.FileType.File:
                    rows.append((f"{folder}/{info.base_name}", None if inside else info.size,
                                 hidden or is_hidden(info.base_name), inside))
                if len(rows) >= 4096:
                    yield sent(rows)
                    rows = []
            if rows:
                yield sent(rows)


def list_tree(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, hidden) of every file below ``root``, empty and hidden ones too.

    Folders are listed by tasks, one level of the tree after the other; a file
    below a hidden folder is hidden.
    """
    shared_dir(spark)
    base = qualified(spark, root)
    folders = spark.createDataFrame([(base, False)], "path string, hidden boolean")
    levels = []
    while True:
        found = folders.repartition("path").mapInArrow(
            _children, "path string, length long, hidden boolean, is_folder boolean").checkpoint()
        levels.append(found.where(~F.col("is_folder")).drop("is_folder"))
        folders = found.where("is_folder").select("path", "hidden")
        if not folders.head(1):
            return reduce(DataFrame.unionByName, levels)


def list_input_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, hidden, name, suffix, wanted) of the files below ``root``.

    ``wanted`` are the data files; scripts, documents and files of other kinds are
    not. File contents are not read.
    """
    name = F.substring_index("path", "/", -1)
    return list_tree(spark, root).withColumns({
        "name": name, "suffix": suffix_of(name)}).withColumn(
        "wanted", ~F.col("suffix").isin(SKIPPED_SUFFIXES)
        & ~F.lower("name").isin(SKIPPED_NAMES)
        & (F.col("suffix").isin(DATA_SUFFIXES) | (F.col("suffix") == "")))


def glob_safe(path: str) -> str:
    """A path that the reader will not expand as a pattern."""
    return "".join("\\" + c if c in "\\[]{}*?" else c for c in path)


def source_path() -> Column:
    """The row's file as listed (``_metadata`` gives it percent-encoded)."""
    encoded = F.col("_metadata.file_path")
    return F.regexp_replace(
        F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def probe_text_files(spark: SparkSession, root: str, suffixes: list[str]) -> DataFrame:
    """(path, valid_utf8, open_quotes, head, sep) per file of the suffixes, in one scan.

    Files of other suffixes are left out by their names, before they are opened.

    ``valid_utf8`` decides the encoding: what is not UTF-8 is read as Latin-1,
    which accepts any byte. ``open_quotes`` marks files with a quoted field
    that runs over a line end; only those need the slower whole-file parser.
    ``head`` is the first non-empty line (of a JSON file its first character, as
    a document may be one long line), ``sep`` the first candidate that
    splits it. Files are split as usual and each task sends one row per file.
    """
    value, block = F.col("value"), F.col("_metadata.file_block_start")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    # Only first-split lines keep their text: the aggregate's rows stay narrow.
    looked = spark.read.option("recursiveFileLookup", True).text(glob_safe(root)).where(
        suffix_of(F.col("_metadata.file_name")).isin(suffixes))
    lines = looked.select(
        source_path().alias("path"),
        F.is_valid_utf8(value).alias("valid"), (quotes % 2 == 1).alias("odd"),
        F.when((block == 0) & (value != ""), F.when(
            F.lower(source_path()).endswith(".json"), F.left(F.ltrim(value), F.lit(1)))
            .otherwise(value)).alias("line"),
        F.monotonically_increasing_id().alias("place"))
    first = F.when(F.col("line").isNotNull(), F.col("place"))
    per_file = lines.groupBy("path").agg(
        F.bool_and("valid").alias("valid_utf8"), F.bool_or("odd").alias("open_quotes"),
        F.min_by("line", first).alias("head"))
    head = F.when(F.col("valid_utf8"), F.col("head")).otherwise(
        F.decode(F.col("head").cast("binary"), "ISO-8859-1"))
    probed = per_file.withColumn("head", F.regexp_replace(head, "^\ufeff", ""))
    return probed.withColumn("sep", sniff_delimiter(F.col("head")))


def sniff_delimiter(head: Column) -> Column:
    """The first candidate giving more than one column, else the comma."""
    sep = F.lit(SNIFFED_SEPARATORS[0])
    for candidate in reversed(SNIFFED_SEPARATORS):
        sep = F.when(head.contains(candidate), F.lit(candidate)).otherwise(sep)
    return sep
