"""Composed flows on the driver tables."""

from __future__ import annotations

import uuid
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.catalog import alpha as alpha_queries
from tickerloom.catalog.labels import BLOCK_SQL, block_text
from tickerloom.catalog.rows import _WORDS
from tickerloom.catalog.tables import iso, table
from tickerloom.catalog.text import NORMALIZED_SQL
from tickerloom.operators import chat, matching, roles
from tickerloom.plans import alpha_news as N
from tickerloom.plans import chat_set
from tickerloom.plans.ingest import ingest, read_ingested
from tickerloom.session import prepare, shared_dir
from tickerloom.sources import readers, sinks
from tickerloom.sources.contracts import news_table, prices_table
from tickerloom.streaming.incremental import incremental_label as stream_labels


def news(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as articles, dated by the order of the same number.

    Copies of a text share a url; documents in one language have no publisher.
    """
    docs = table(spark, sf, "documents")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate").join(
        docs.select(F.col("doc_id").alias("o_orderkey")).distinct(), "o_orderkey", "left_semi")
    raw = docs.join(orders, docs.doc_id == orders.o_orderkey, "left").select(
        "doc_id", F.concat(F.lit("https://n/"), F.sha2("text", 256)).alias("url"),
        F.date_format("o_orderdate", "EEE, dd MMM yyyy HH:mm:ss 'GMT'").alias("published"),
        F.col("source").alias("title"), F.col("lang").alias("description"),
        F.struct(F.nullif("lang", F.lit("en")).alias("title")).alias("publisher"),
        F.col("text").alias("full_text"))
    return news_table(raw)


def companies_and_keywords(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    words = table(spark, sf, "benchmark").select(
        "item_id", matching.words_of(F.col("text")).alias("w"))
    companies = words.select(F.col("item_id").alias("ticker"),
                             F.array_join(F.slice("w", 1, 2), " ").alias("company_name"))
    keywords = words.groupBy(F.get("w", F.lit(2)).alias("keyword")).agg(
        F.min("item_id").cast("int").alias("kw_idx"))
    return companies, keywords


def alpha_news_records(spark: SparkSession, sf: str) -> DataFrame:
    companies, keywords = companies_and_keywords(spark, sf)
    return N.alpha_news(news(spark, sf), alpha_queries.prices(spark, sf),
                        alpha_queries.benchmark(spark, sf), companies, keywords)


def news_contract(spark: SparkSession, sf: str) -> DataFrame:
    return news(spark, sf).select("doc_id", "url", iso(F.col("event_date")).alias("event_date"),
                                  "title", "description", "publisher")


def prices_contract(spark: SparkSession, sf: str) -> DataFrame:
    """The last event value of a user and day as its close."""
    raw = table(spark, sf, "events").select(
        F.col("user_id").alias("ticker"), "ts",
        F.when(F.col("event_type") != "error", F.col("value")).alias("close"))
    return prices_table(raw).select("ticker", iso(F.col("date")).alias("date"), "close")


def label_batches(spark: SparkSession, sf: str) -> DataFrame:
    """A rule instead of a model, to check batching and the marker test."""
    def rule(prompts: pd.Series) -> pd.Series:
        size = prompts.str.len()
        block = "Sentiment: Neutral\nConfidence: " + size.astype(str)
        return block.where(size % 2 == 1, block + "\nDecision: HOLD")

    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("input"))
    return chat.label_batches(docs, rule).select("doc_id", "output")


def known_responses(spark: SparkSession, sf: str) -> DataFrame:
    return block_text(spark, sf).select(F.col("text").alias("input"), "output")


def label_from_table(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("input"))
    responses = known_responses(spark, sf)
    good = table(spark, sf, "labels").where("quality = 1").select("doc_id")
    labelled = docs.join(good, "doc_id", "left_semi").select(
        "input", F.lit("Sentiment: Neutral\nDecision: HOLD").alias("output"))
    return chat_set.label_pending(
        docs, labelled, lambda df: chat.label_from_table(df, responses)
    ).select("doc_id", "output")


def incremental_label(spark: SparkSession, sf: str) -> DataFrame:
    """Documents arriving as a stream, labelled in two runs of the same job."""
    base = f"{shared_dir(prepare(spark))}/labels-{uuid.uuid4().hex}"
    schema = table(spark, sf, "documents").schema
    responses = known_responses(spark, sf)
    arriving = spark.readStream.schema(schema).parquet(f"{sf}/documents*.parquet").select(
        F.col("text").alias("input"))
    for _ in range(2):
        stream_labels(spark, arriving, f"{base}/labelled", f"{base}/progress",
                      lambda df: chat.label_from_table(df, responses)).awaitTermination()
    return readers.read_jsonl_lenient(spark, f"{base}/labelled", chat_set.LABELLED_SCHEMA)


def chat_training_set(spark: SparkSession, sf: str) -> DataFrame:
    """Texts to a JSON folder, labelled, rewritten as chat, read back."""
    base = f"{shared_dir(prepare(spark))}/chat-{uuid.uuid4().hex}"
    texts = table(spark, sf, "documents").select(F.col("text").alias("input"))
    sinks.overwrite_jsonl(texts, f"{base}/inputs")
    known = chat.known_outputs(known_responses(spark, sf)).checkpoint()
    chat_set.chat_training_set(
        spark, f"{base}/inputs", f"{base}/labelled", f"{base}/chat",
        lambda df: chat.label_from_known(df, known))
    return readers.read_chat_dataset(spark, f"{base}/chat").select(
        chat.render_chat(F.col("messages")).alias("text"))


class Crash(Exception):
    pass


def incremental_news(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs, the first of which dies between its records and its log."""
    base = f"{shared_dir(prepare(spark))}/news-{uuid.uuid4().hex}"
    companies, keywords = companies_and_keywords(spark, sf)
    # Every run reads the articles several times; they are put together once.
    inputs = (news(spark, sf).checkpoint(), alpha_queries.prices(spark, sf),
              alpha_queries.benchmark(spark, sf), companies, keywords)

    def crash() -> None:
        raise Crash

    for written in (crash, lambda: None, lambda: None):
        try:
            N.incremental_news(spark, *inputs, f"{base}/records", f"{base}/done", written)
        except Crash:
            pass
    records = readers.read_jsonl_lenient(
        spark, f"{base}/records", "ticker long, company_name string, published_date string, "
                                  "news_text string, true_alpha int")
    done = readers.read_checkpoint(spark, f"{base}/done").select(
        F.col("ticker").cast("long").alias("ticker"), F.lit(True).alias("checkpointed"))
    return records.join(done, "ticker", "left")


def newly_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of three labelling runs: over labelled documents, over all, over all again."""
    base = f"{shared_dir(prepare(spark))}/newly-{uuid.uuid4().hex}"
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("input"))
    marked = docs.join(table(spark, sf, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    known = chat.known_outputs(known_responses(spark, sf)).checkpoint()
    found = []
    for run, texts in enumerate([marked, docs, docs]):
        sinks.overwrite_jsonl(texts.select("input"), f"{base}/inputs{run}")
        counts = chat_set.chat_training_set(
            spark, f"{base}/inputs{run}", f"{base}/labelled", f"{base}/chat",
            lambda df: chat.label_from_known(df, known))
        found.append(counts.withColumn("run", F.lit(run)))
    return reduce(DataFrame.unionByName, found)


def infer_roles(spark: SparkSession, sf: str) -> DataFrame:
    """Column roles of four tables."""
    found = []
    orders = table(spark, sf, "orders").withColumn(
        "o_orderdate", F.date_format("o_orderdate", "dd/MM/yyyy"))
    for name, df in [("orders", orders), ("documents", table(spark, sf, "documents")),
                     ("labels", table(spark, sf, "labels")), ("events", table(spark, sf, "events"))]:
        role = roles.infer_roles(df)
        found.append((name, role.date, ",".join(role.text), ",".join(role.target)))
    return spark.createDataFrame(
        found, "table_name string, date_column string, text_columns string, "
               "target_columns string")


def ingest_files(spark: SparkSession, sf: str) -> DataFrame:
    """Every document written twice to CSV files by source, ingested, read back.

    Both copies share a file, so labelled documents come back once and
    unlabelled ones twice.
    """
    base = f"{shared_dir(prepare(spark))}/files-{uuid.uuid4().hex}"
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("doc_id"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("publish_date"))
    labels = table(spark, sf, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "GOOD").otherwise("very-bad").alias("label"))
    rows = docs.join(orders, "doc_id", "left").join(labels, "doc_id", "left")
    twice = rows.unionByName(rows).repartition("doc_id")
    twice.write.partitionBy("source").option("header", True).option("escape", '"').option(
        "quoteAll", True).csv(f"{base}/in")
    manifest = ingest(spark, f"{base}/in", f"{base}/out")
    groups = [r.schema_group for r in manifest.where("status = 'success'")
              .select("schema_group").distinct().collect()]
    parts = [read_ingested(spark, f"{base}/out", g).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("date").cast("string").alias("date"),
        "text", F.col("sentiment").cast("string").alias("sentiment")) for g in groups]
    return reduce(DataFrame.unionByName, parts)


QUERIES = {
    "ingest_files": ingest_files,
    "alpha_news_records": alpha_news_records,
    "incremental_news": incremental_news,
    "newly_labelled": newly_labelled,
    "news_contract": news_contract,
    "prices_contract": prices_contract,
    "label_batches": label_batches,
    "label_from_table": label_from_table,
    "incremental_label": incremental_label,
    "chat_training_set": chat_training_set,
    "infer_roles": infer_roles,
}

_LABELLED = f"""
blocks AS ({BLOCK_SQL}),
known AS (
  SELECT text, min(output) AS output FROM blocks
  WHERE contains(output, 'Sentiment:') AND contains(output, 'Decision:') GROUP BY text)"""

_NEWS = """
news AS (
  SELECT doc_id, 'https://n/' || sha256(text) AS url, CAST(o_orderdate AS DATE) AS event_date,
         source AS title, lang AS description,
         coalesce(nullif(lang, 'en'), 'Unknown Source') AS publisher, text AS full_text
  FROM documents LEFT JOIN orders ON doc_id = o_orderkey)"""

_STRIP = "trim(full_text, chr(10) || chr(9) || chr(13) || ' ')"

_SYSTEM_SQL = "'" + chat.SYSTEM_PROMPT.replace("'", "''") + "'"

ORACLES = {
    "ingest_files": f"""
WITH src AS (
  SELECT d.doc_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS date, text,
         CASE quality WHEN 1 THEN 'Good' WHEN 0 THEN 'Very-Bad' END AS sentiment
  FROM documents d LEFT JOIN orders ON d.doc_id = o_orderkey
  LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT doc_id, date, {NORMALIZED_SQL} AS text, sentiment FROM src
UNION ALL SELECT doc_id, date, {NORMALIZED_SQL} AS text, sentiment FROM src
WHERE sentiment IS NULL""",
    "infer_roles": """
SELECT 'orders' AS table_name, (
         SELECT CASE WHEN avg((try_strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y')
                               IS NOT NULL)::INT) >= 0.3 THEN 'o_orderdate' END
         FROM orders) AS date_column, '' AS text_columns, '' AS target_columns
UNION ALL SELECT 'documents', NULL, (
         SELECT CASE WHEN count(text) > count(TRY_CAST(text AS DOUBLE)) THEN 'text' ELSE '' END
         FROM documents), ''
UNION ALL SELECT 'labels', NULL, '', ''
UNION ALL SELECT 'events', 'ts', '', ''""",
    "news_contract": f"""WITH {_NEWS}
SELECT doc_id, url, strftime(event_date, '%Y-%m-%d') AS event_date, title, description, publisher
FROM news""",
    "alpha_news_records": f"""WITH {alpha_queries._PRICES}, {_NEWS},
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
companies AS (SELECT item_id AS ticker, w[1] || ' ' || w[2] AS phrase FROM b),
keywords AS (SELECT CAST(min(item_id) AS INTEGER) AS kw_idx, w[3] AS word FROM b GROUP BY w[3]),
d AS (SELECT doc_id, {_WORDS.replace('text', "title || ' ' || description || ' ' || full_text")} AS w
      FROM news),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
singles AS (SELECT DISTINCT doc_id, w[i] AS word FROM pos),
pairs AS (SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] AS phrase FROM pos WHERE i < len(w)),
hits AS (
  SELECT DISTINCT p.doc_id, c.ticker, k.kw_idx
  FROM pairs p JOIN companies c ON p.phrase = c.phrase
  JOIN singles s ON s.doc_id = p.doc_id JOIN keywords k ON k.word = s.word),
ranked AS (
  SELECT h.*, n.url, n.event_date,
         row_number() OVER (PARTITION BY ticker, kw_idx
                            ORDER BY event_date DESC NULLS LAST, url, h.doc_id) AS rank
  FROM hits h JOIN news n ON h.doc_id = n.doc_id),
firsts AS (
  SELECT * FROM ranked
  QUALIFY row_number() OVER (PARTITION BY ticker, url ORDER BY kw_idx, rank) = 1),
labelled AS (
  SELECT e.*, f.end_date, (f.s_end - f.close) / f.close
           - (f.b_end - f.bench_close) / f.bench_close AS alpha
  FROM firsts e ASOF JOIN fwd f ON e.ticker = f.ticker AND e.event_date < f.date
  WHERE e.event_date IS NOT NULL AND f.close > 0 AND f.bench_close > 0)
SELECT l.ticker, c.phrase AS company_name, strftime(l.event_date, '%Y-%m-%d') AS published_date,
       CASE WHEN length({_STRIP}) > 300 THEN {_STRIP}
            ELSE title || ' | ' || publisher || ' | ' || description END AS news_text,
       CAST(alpha > 0 AS INTEGER) AS true_alpha, l.kw_idx
FROM labelled l JOIN news n ON l.doc_id = n.doc_id JOIN companies c ON c.ticker = l.ticker
WHERE l.end_date < l.event_date + INTERVAL 35 DAY AND alpha IS NOT NULL
  AND length(CASE WHEN length({_STRIP}) > 300 THEN {_STRIP}
            ELSE title || ' | ' || publisher || ' | ' || description END) > 50""",
    "prices_contract": """
SELECT user_id AS ticker, strftime(ts, '%Y-%m-%d') AS date,
       arg_max(value, {'t': ts, 'v': value}) AS close
FROM events WHERE event_type <> 'error' AND value IS NOT NULL GROUP BY 1, 2""",
    "label_batches": """
WITH p AS (
  SELECT doc_id, length('Analyze this text:' || chr(10) || chr(10) || text) AS n
  FROM documents)
SELECT doc_id, 'Sentiment: Neutral' || chr(10) || 'Confidence: ' || n
       || chr(10) || 'Decision: HOLD' AS output
FROM p WHERE n % 2 = 0""",
    "label_from_table": f"""WITH {_LABELLED}
SELECT doc_id, output FROM documents d JOIN known k ON d.text = k.text
WHERE d.text NOT IN (
  SELECT text FROM documents JOIN labels USING (doc_id) WHERE quality = 1 AND text IS NOT NULL)""",
    "incremental_label": f"""WITH {_LABELLED}
SELECT d.text AS input, output FROM documents d JOIN known k ON d.text = k.text""",
    "chat_training_set": f"""WITH {_LABELLED}
SELECT '<|im_start|>system' || chr(10) || {_SYSTEM_SQL} || '<|im_end|>' || chr(10)
       || '<|im_start|>user' || chr(10) || d.text || '<|im_end|>' || chr(10)
       || '<|im_start|>assistant' || chr(10) || output || '<|im_end|>' || chr(10) AS text
FROM documents d JOIN known k ON d.text = k.text""",
}
ORACLES["incremental_news"] = f"""
SELECT ticker, company_name, published_date, news_text, true_alpha, TRUE AS checkpointed
FROM ({ORACLES["alpha_news_records"]})"""
ORACLES["newly_labelled"] = f"""WITH {_LABELLED},
hits AS (SELECT d.doc_id, d.text FROM documents d JOIN known k ON d.text = k.text),
first AS (SELECT * FROM hits WHERE doc_id IN (SELECT doc_id FROM labels)),
second AS (SELECT * FROM hits WHERE text NOT IN (SELECT text FROM first)),
counts AS (SELECT (SELECT count(*) FROM first) AS a, (SELECT count(*) FROM second) AS b)
SELECT 0 AS run, a AS newly_labelled, a AS chat_records FROM counts
UNION ALL SELECT 1, b, a + b FROM counts
UNION ALL SELECT 2, 0, a + b FROM counts"""
