"""File readers: delimited text, JSON, Parquet, chat and checkpoint files."""

from __future__ import annotations

import csv

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from tickerloom.functions.naming import col
from tickerloom.functions.text import trim_ws
from tickerloom.operators.chat import MESSAGES_TYPE
from tickerloom.sources.listing import glob_safe, source_path

# --- fixed values -----------------------------------------------------------
NULL_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
ENCODINGS = {"utf-8": "UTF-8", "latin1": "ISO-8859-1"}
# ----------------------------------------------------------------------------

PATH, PLACE = "__path", "__place"
_SURPLUS = "__surplus"


def header_names(line: str, sep: str) -> list[str]:
    """Column names from a header line: trimmed, blanks numbered, repeats suffixed."""
    cells = next(csv.reader([line], delimiter=sep))
    names: list[str] = []
    for index, cell in enumerate(cells):
        base = cell.strip() or f"Unnamed: {index}"
        name, copy = base, 0
        while name in names:
            copy += 1
            name = f"{base}.{copy}"
        names.append(name)
    return names


def _with_source(df: DataFrame) -> DataFrame:
    return df.select("*", source_path().alias(PATH),
                     F.monotonically_increasing_id().alias(PLACE))


def read_delimited(spark: SparkSession, paths: list[str], names: list[str], *,
                   sep: str = ",", header: bool = True, encoding: str = "utf-8",
                   multiline: bool = False) -> DataFrame:
    """Delimited text of files or folders as string columns, with source path and row place.

    Short rows are padded with nulls, rows with surplus values are dropped: one
    spare column catches the surplus. (A surplus value that is empty cannot be
    told from none; such a row stays.) The usual spellings of "not available"
    become null. Without ``multiline`` large files are split.
    """
    schema = StructType([StructField(n, StringType()) for n in [*names, _SURPLUS]])
    raw = (
        spark.read.schema(schema).option("sep", sep).option("header", header)
        .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
        .option("multiLine", multiline).option("encoding", ENCODINGS.get(encoding, encoding))
        .option("maxCharsPerColumn", -1).option("recursiveFileLookup", True)
        .csv([glob_safe(p) for p in paths])
    )
    kept = _with_source(raw).where(col(_SURPLUS).isNull())
    return kept.select(*[F.when(~col(n).isin(NULL_WORDS), col(n)).alias(n) for n in names],
                       PATH, PLACE)


def read_tsv(spark: SparkSession, paths: list[str], names: list[str], **options) -> DataFrame:
    return read_delimited(spark, paths, names, sep="\t", **options)


def read_headerless(spark: SparkSession, paths: list[str], names: list[str],
                    **options) -> DataFrame:
    return read_delimited(spark, paths, names, header=False, **options)


def any_case(suffix: str) -> str:
    """A glob for names that end in ``suffix`` in any case."""
    return "*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)


def _below(spark: SparkSession, suffix: str | None):
    """A reader of files or whole folders, of the latter only files of a suffix."""
    reader = spark.read.option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", any_case(suffix)) if suffix else reader


def read_parquet(spark: SparkSession, paths: list[str], suffix: str | None = None) -> DataFrame:
    return _with_source(_flat(_below(spark, suffix).option("mergeSchema", True).parquet(
        *[glob_safe(p) for p in paths])))


def read_json(spark: SparkSession, paths: list[str], lines: bool,
              suffix: str | None = None) -> DataFrame:
    """JSON documents (``lines=False``) or one record per line.

    A file that holds no readable document is tried as lines; a malformed record
    is an error.
    """
    escaped = [glob_safe(p) for p in paths]
    df = _below(spark, suffix).option("multiLine", not lines).json(escaped)
    if not lines and df.columns == ["_corrupt_record"]:
        df = _below(spark, suffix).json(escaped)
    if df.columns == ["_corrupt_record"]:
        raise ValueError("no readable JSON record")
    if "_corrupt_record" in df.columns:
        if df.where("_corrupt_record is not null").head(1):
            raise ValueError("a JSON record is malformed")
        df = df.drop("_corrupt_record")
    return _with_source(_flat(df))


def _flat(df: DataFrame) -> DataFrame:
    """Nested values as JSON text; everything else as it is."""
    nested = [f.name for f in df.schema if isinstance(f.dataType, (StructType, ArrayType, MapType))]
    return df.withColumns({n: F.to_json(col(n)) for n in nested}) if nested else df


def rows_or_none(spark: SparkSession, load, schema) -> DataFrame:
    """``load()``, or no rows when the path is not there yet."""
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def read_jsonl_lenient(spark: SparkSession, path: str | list[str],
                       schema: str | StructType) -> DataFrame:
    """JSON lines with malformed ones skipped; a missing path has no rows.

    Folders are read with all folders below, but for hidden ones.
    """
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    read_as = StructType([*wanted.fields, StructField("_corrupt_record", StringType())])

    def load() -> DataFrame:
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
        lines = spark.read.option("recursiveFileLookup", True).text(path).where(
            F.trim("value") != "")
        parsed = lines.select(F.from_json("value", read_as, options).alias("r")).select("r.*")
        return parsed.where("_corrupt_record is null").drop("_corrupt_record")

    return rows_or_none(spark, load, wanted)


def read_chat_dataset(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl_lenient(spark, path, f"messages {MESSAGES_TYPE}").where(
        "messages is not null")


def read_checkpoint(spark: SparkSession, path: str, key: str = "ticker") -> DataFrame:
    """The keys done so far, one per line."""
    def load() -> DataFrame:
        return spark.read.option("recursiveFileLookup", True).text(path).select(
            trim_ws(F.col("value")).alias(key)).distinct()

    return rows_or_none(spark, load, f"{key} string")
