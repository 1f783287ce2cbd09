"""Ingest of one table in each shape of file: written out, ingested, read back."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.catalog.tables import table
from tickerloom.plans.ingest import ingest, read_in_order, read_ingested, totals
from tickerloom.session import prepare, shared_dir


def orders_text(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as (code, content, date), all as text."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("code"),
        F.concat_ws(" ", F.lit("Order"), "o_orderkey", "o_orderpriority").alias("content"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))


def _place(spark: SparkSession, raw: str, folder: str, name: Callable[[int], str]) -> None:
    """Move the part files of a written folder to ``folder/<n>/<name>``, n of five digits."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(raw).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    parts = sorted(s.getPath().toString() for s in system.listStatus(path(raw))
                   if s.getPath().getName().startswith("part-"))
    for number, part in enumerate(parts):
        target = path(f"{folder}/{number:05d}/{name(number)}")
        system.mkdirs(target.getParent())
        system.rename(path(part), target)


def _written(spark: SparkSession, write: Callable[[str], None], name: Callable[[int], str] | str,
             folder: str = "") -> str:
    """A fresh input root that holds what ``write`` writes; returns its base."""
    base = f"{shared_dir(prepare(spark))}/shape-{uuid.uuid4().hex}"
    write(f"{base}/raw")
    _place(spark, f"{base}/raw", f"{base}/in{folder}", name if callable(name) else lambda _: name)
    return base


def _groups(manifest: DataFrame) -> list[int]:
    return sorted(r.schema_group for r in manifest.where("status = 'success'")
                  .select("schema_group").distinct().collect())


def _read_back(spark: SparkSession, base: str, *columns: Column) -> DataFrame:
    manifest = ingest(spark, f"{base}/in", f"{base}/out")
    return reduce(DataFrame.unionByName, [
        read_ingested(spark, f"{base}/out", g).select(*columns) for g in _groups(manifest)])


def _orders_back(spark: SparkSession, base: str) -> DataFrame:
    return _read_back(spark, base, F.col("code").cast("long").alias("code"), F.col("content"),
                      F.col("date").cast("string").alias("date"))


def ingest_tsv(spark: SparkSession, sf: str) -> DataFrame:
    rows = orders_text(spark, sf)
    return _orders_back(spark, _written(
        spark, lambda p: rows.write.option("sep", "\t").option("header", True).csv(p), "o.tsv"))


def ingest_sniffed(spark: SparkSession, sf: str) -> DataFrame:
    """Files without a suffix, separated by bars."""
    rows = orders_text(spark, sf)
    return _orders_back(spark, _written(
        spark, lambda p: rows.write.option("sep", "|").option("header", True).csv(p), "dump"))


def ingest_parquet(spark: SparkSession, sf: str) -> DataFrame:
    rows = orders_text(spark, sf).withColumns({
        "code": F.col("code").cast("long"), "date": F.col("date").cast("timestamp")})
    return _orders_back(spark, _written(spark, lambda p: rows.write.parquet(p), "o.parquet"))


def ingest_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    rows = orders_text(spark, sf)
    return _orders_back(spark, _written(spark, lambda p: rows.write.json(p), "o.jsonl"))


def ingest_json_array(spark: SparkSession, sf: str) -> DataFrame:
    """Files that are one JSON array each, of the orders of 65,536 neighbouring keys."""
    arrays = orders_text(spark, sf).groupBy(F.expr("cast(code as long) div 65536").alias("file")).agg(
        F.to_json(F.collect_list(F.struct("code", "content", "date"))).alias("value"))
    return _orders_back(spark, _written(
        spark, lambda p: arrays.select("value").write.option("maxRecordsPerFile", 1).text(p),
        "o.json"))


def ingest_skipped_dates(spark: SparkSession, sf: str) -> DataFrame:
    """A file rule that leaves dates as they are."""
    rows = orders_text(spark, sf)
    return _orders_back(spark, _written(
        spark, lambda p: rows.write.option("header", True).csv(p), "training_data_26000.csv"))


def ingest_renamed(spark: SparkSession, sf: str) -> DataFrame:
    """A file rule that renames columns."""
    rows = orders_text(spark, sf).withColumnsRenamed({"content": "Text", "date": "Date"})
    base = _written(spark, lambda p: rows.write.option("header", True).csv(p),
                    "GNEW_list_2022_processed.csv")
    return _read_back(spark, base, F.col("code").cast("long").alias("code"),
                      F.col("text").alias("content"), F.col("date").cast("string").alias("date"))


def ingest_exact_dates(spark: SparkSession, sf: str) -> DataFrame:
    """A folder rule with a date pattern over a headerless file with imposed names."""
    rows = orders_text(spark, sf).select(F.replace("date", F.lit("-"), F.lit("")), "code", "content")
    base = _written(spark, lambda p: rows.write.csv(p), "india-news-headlines.csv",
                    "/Stock Market Prediction  India news headlines")
    return _read_back(spark, base, F.col("Category").cast("long").alias("code"),
                      F.col("Headline").alias("content"),
                      F.col("Date").cast("string").alias("date"))


def ingest_agreement(spark: SparkSession, sf: str) -> DataFrame:
    """Headerless sentences and labels, separated by an at sign; labelled copies collapse."""
    rows = table(spark, sf, "part").select("p_name", "p_brand")
    twice = rows.unionByName(rows).repartition(4, "p_name", "p_brand")
    base = _written(spark, lambda p: twice.select(F.concat_ws("@", "p_name", "p_brand")
                                                  .alias("value")).write.text(p),
                    "Sentences_50Agree.txt")
    return _read_back(spark, base, "text", "sentiment")


def ingest_symbols(spark: SparkSession, sf: str) -> DataFrame:
    """Price files below the index folder get their name as symbol."""
    rows = orders_text(spark, sf).repartition(4, "code").sortWithinPartitions("code")
    base = _written(spark, lambda p: rows.write.option("header", True).csv(p),
                    lambda n: f"SYM{n}.csv", "/NIFTY 50")
    back = _read_back(spark, base, F.col("code").cast("long").alias("code"), "Symbol")
    return back.groupBy(F.regexp_replace("Symbol", r"\d+$", "").alias("symbol")).agg(
        F.count("*").alias("n_rows"), F.countDistinct("code").alias("n_codes"))


def ingest_wide_table(spark: SparkSession, sf: str) -> DataFrame:
    """A wide table becomes one row per date and headline."""
    rows = orders_text(spark, sf).select(
        F.col("date").alias("Date"), F.col("content").alias("h1"),
        F.nullif(F.concat(F.lit("Code "), F.col("code")), F.lit("Code 7")).alias("h2"))
    base = _written(spark, lambda p: rows.write.option("header", True).csv(p), "mnews_2014.csv")
    return _read_back(spark, base, F.col("date").cast("string").alias("date"), "text")


def ingest_with_a_bad_file(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of a run in which one of two files cannot be read."""
    rows = orders_text(spark, sf).coalesce(1)
    base = _written(spark, lambda p: rows.write.option("header", True).csv(p), "good.csv")
    rows.limit(1).select("content").write.text(f"{base}/raw2")
    _place(spark, f"{base}/raw2", f"{base}/in/bad", lambda _: "bad.parquet")
    return totals(ingest(spark, f"{base}/in", f"{base}/out"))


def ingest_latin1(spark: SparkSession, sf: str) -> DataFrame:
    """Files in Latin-1 beside others in UTF-8, both with accented labels."""
    rows = orders_text(spark, sf).select(
        "code", F.concat(F.lit("Café "), "content").alias("content"),
        F.when(F.col("code").cast("long") % 3 == 0, "très élevé").otherwise("ça baisse")
         .alias("sentiment"))
    even = F.col("code").cast("long") % 2 == 0

    def write(part: DataFrame, encoding: str) -> Callable[[str], None]:
        return lambda p: part.write.option("header", True).option("encoding", encoding).csv(p)

    base = _written(spark, write(rows.where(even), "ISO-8859-1"), "o.csv", "/latin1")
    write(rows.where(~even), "UTF-8")(f"{base}/raw2")
    _place(spark, f"{base}/raw2", f"{base}/in/utf8", lambda _: "o.csv")
    return _read_back(spark, base, F.col("code").cast("long").alias("code"), "content",
                      "sentiment", F.substring_index("source_folder", "/", 1).alias("encoding"))


def ingest_dropped_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Header cells without a name: one file rule and one folder rule drop their columns."""
    rows = orders_text(spark, sf)
    by_file = rows.select(F.col("content").alias("Text"), F.col("date").alias("Date"),
                          F.lit("x").alias(" "), "code")
    base = _written(spark, lambda p: by_file.write.option("header", True).csv(p),
                    "GNEW_list_2021_processed.csv")
    by_folder = rows.select(
        F.lit("0").alias(" "), "code", F.col("content").alias("text"),
        F.concat_ws("-", *[F.get(F.split("date", "-"), F.lit(i)) for i in (2, 1, 0)])
        .alias("date"), F.lit("y").alias("  "))
    by_folder.write.option("header", True).csv(f"{base}/raw2")
    _place(spark, f"{base}/raw2", f"{base}/in/Business News Description with sentiment",
           lambda _: "news.csv")
    manifest = ingest(spark, f"{base}/in", f"{base}/out")
    found = []
    for group in _groups(manifest):
        back = read_ingested(spark, f"{base}/out", group)
        names = ",".join(sorted(set(back.columns) - {
            "schema_group", "source_folder", "source_file"}))
        found.append(back.select(
            F.lit(names).alias("names"), F.col("source_file"),
            F.col("code").cast("long").alias("code"), F.col("text").alias("content"),
            F.col("date").cast("string").alias("date")))
    return reduce(DataFrame.unionByName, found)


def ingest_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in falling order, each twice; the output keeps the order and the first copies."""
    copies = F.explode(F.array(F.lit(0), F.lit(1))).alias("copy")
    key = F.col("code").cast("long")
    rows = (orders_text(spark, sf).select("*", copies).repartitionByRange(4, key.desc())
            .sortWithinPartitions("copy", key.desc()).drop("copy"))
    base = _written(spark, lambda p: rows.write.option("header", True).csv(p), "o.csv")
    manifest = ingest(spark, f"{base}/in", f"{base}/out", keep_order=True)
    (group,) = _groups(manifest)
    return read_in_order(spark, f"{base}/out", group).select(
        "line", F.col("code").cast("long").alias("code"), "content",
        F.col("date").cast("string").alias("date"))


def ingest_replaced(spark: SparkSession, sf: str) -> DataFrame:
    """A second run over other files takes the place of the first one's output."""
    first = orders_text(spark, sf)
    base = _written(spark, lambda p: first.write.option("header", True).csv(p), "old.csv")
    ingest(spark, f"{base}/in", f"{base}/out")
    rows = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("code"), F.col("p_name").alias("content"))
    rows.write.option("header", True).csv(f"{base}/raw2")
    _place(spark, f"{base}/raw2", f"{base}/new", lambda _: "new.csv")
    manifest = ingest(spark, f"{base}/new", f"{base}/out")
    return reduce(DataFrame.unionByName, [
        read_ingested(spark, f"{base}/out", g).select(
            "source_file", F.col("code").cast("long").alias("code"), "content")
        for g in _groups(manifest)])


QUERIES = {
    "ingest_latin1": ingest_latin1,
    "ingest_dropped_columns": ingest_dropped_columns,
    "ingest_in_order": ingest_in_order,
    "ingest_replaced": ingest_replaced,
    "ingest_tsv": ingest_tsv,
    "ingest_sniffed": ingest_sniffed,
    "ingest_parquet": ingest_parquet,
    "ingest_json_lines": ingest_json_lines,
    "ingest_json_array": ingest_json_array,
    "ingest_skipped_dates": ingest_skipped_dates,
    "ingest_renamed": ingest_renamed,
    "ingest_exact_dates": ingest_exact_dates,
    "ingest_agreement": ingest_agreement,
    "ingest_symbols": ingest_symbols,
    "ingest_wide_table": ingest_wide_table,
    "ingest_with_a_bad_file": ingest_with_a_bad_file,
}

_CONTENT = "lower('Order ' || o_orderkey || ' ' || o_orderpriority)"
_ORDERS = f"""
SELECT o_orderkey AS code, {_CONTENT} AS content,
       strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' AS date FROM orders"""

ORACLES = {
    **{name: _ORDERS for name in (
        "ingest_tsv", "ingest_sniffed", "ingest_parquet", "ingest_json_lines",
        "ingest_json_array", "ingest_renamed", "ingest_exact_dates")},
    "ingest_skipped_dates": _ORDERS.replace(" || ' 00:00:00'", ""),
    "ingest_latin1": f"""
SELECT o_orderkey AS code, 'caf ' || {_CONTENT} AS content,
       CASE WHEN o_orderkey % 3 = 0 THEN 'Très Élevé' ELSE 'Ça Baisse' END AS sentiment,
       CASE WHEN o_orderkey % 2 = 0 THEN 'latin1' ELSE 'utf8' END AS encoding
FROM orders""",
    "ingest_dropped_columns": f"""
SELECT 'code,date,text' AS names, f.source_file, o.* FROM ({_ORDERS}) o,
  (VALUES ('GNEW_list_2021_processed.csv'), ('news.csv')) f(source_file)""",
    "ingest_in_order": f"""
SELECT row_number() OVER (ORDER BY code DESC) AS line, * FROM ({_ORDERS})""",
    "ingest_replaced": """
SELECT 'new.csv' AS source_file, p_partkey AS code, lower(p_name) AS content FROM part""",
    "ingest_agreement": """
SELECT DISTINCT lower(p_name) AS text,
       upper(p_brand[1]) || lower(p_brand[2:]) AS sentiment FROM part""",
    "ingest_symbols": """
SELECT 'SYM' AS symbol, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_codes FROM orders""",
    "ingest_wide_table": f"""
SELECT strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' AS date, {_CONTENT} AS text FROM orders
UNION ALL
SELECT strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00', 'code ' || o_orderkey FROM orders
WHERE o_orderkey <> 7""",
    "ingest_with_a_bad_file": """
SELECT 2::BIGINT AS total, 1::BIGINT AS success, 1::BIGINT AS failed,
       count(*)::BIGINT AS rows_in, count(*)::BIGINT AS rows_out FROM orders""",
}
