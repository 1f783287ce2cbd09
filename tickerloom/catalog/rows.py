"""Queries on whole rows: dedup, ranking, matching, reshaping, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.catalog.alpha import events
from tickerloom.catalog.tables import table
from tickerloom.operators import aggregates, columns, dedup, filters, joins, matching, ranking
from tickerloom.sources.dims import KEYWORDS


def dedup_rows(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_rows(table(spark, sf, "documents").select("text", "lang"))


def dedup_per_file(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_rows(table(spark, sf, "documents").select("source", "text", "lang"))


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    labels = table(spark, sf, "labels").select(
        "doc_id", F.col("quality").cast("string").alias("sentiment"))
    return docs.join(labels, "doc_id", "left").select("text", "lang", "sentiment")


def dedup_keep_unlabelled(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_keep_unlabelled(labelled_documents(spark, sf), ["sentiment"])


def bare_url(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, r"^https?://", ""), r"[?#].*$", "")


def first_seen(spark: SparkSession, sf: str) -> DataFrame:
    """First page per host and address; the host stands for the ticker."""
    address = bare_url(F.col("url"))
    pages = table(spark, sf, "pages").select(
        "page_id", "url", F.substring_index(address, "/", 1).alias("host"),
        address.alias("address"))
    return ranking.first_seen(pages, ["host", "address"], ["page_id"])


def first_seen_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(
        "doc_id", F.sha2("text", 256).alias("digest"))
    return ranking.first_seen(docs, ["digest"], ["doc_id"])


def top_k_per_group(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("event_id", "event_type", "user_id", "value")
    return ranking.top_k_per_group(
        rows, ["event_type"], [F.desc("value"), F.asc("event_id")],
        ranking.RESULTS_PER_SEARCH, salt_on=["event_id"])


def search_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Customers stand for companies, each with the whole keyword list."""
    companies = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("ticker"), F.col("c_name").alias("company_name"))
    return joins.search_terms(companies, list(enumerate(KEYWORDS)))


def keyword_match(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark items stand for companies: two words name one, the third is a keyword."""
    words = table(spark, sf, "benchmark").select(
        "item_id", matching.words_of(F.col("text")).alias("w"))
    companies = words.select(F.col("item_id").alias("ticker"),
                             F.array_join(F.slice("w", 1, 2), " ").alias("company_name"))
    keywords = words.groupBy(F.get("w", F.lit(2)).alias("keyword")).agg(
        F.min("item_id").cast("int").alias("kw_idx"))
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return matching.match_news(docs, companies, keywords)


def unpivot_wide(spark: SparkSession, sf: str) -> DataFrame:
    wide = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Day"), "o_orderstatus",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"), "o_custkey")
    return columns.unpivot_headlines(wide, "Day").groupBy("date", "text").agg(
        F.count("*").alias("n"))


def text_choice(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    rows = docs.join(table(spark, sf, "labels"), "doc_id", "left")
    full = F.when(F.col("quality") == 1, F.col("text"))
    chosen = columns.choose_text(F.col("source"), columns.publisher_title(F.col("lang")),
                                 F.when(F.col("toxic") == 1, F.col("text")), full)
    picked = rows.select("doc_id", chosen.alias("news_text"))
    return filters.min_length(picked, "news_text")


def resume_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose exact text was not labelled under any id."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("input"))
    labelled = docs.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    return joins.skip_labelled(filters.non_blank(docs, "input"), labelled)


def skip_completed(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    done = table(spark, sf, "orders").where("o_totalprice > 450000").select(
        F.col("o_custkey").alias("c_custkey"))
    return joins.skip_completed(customers, done, "c_custkey")


def saved_per_group(spark: SparkSession, sf: str) -> DataFrame:
    """Events kept per supplier, zeros reported."""
    groups = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("ticker"))
    return aggregates.kept_per_group(groups, events(spark, sf), ["ticker"])


def ingest_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in and out per source file, with a status."""
    docs = table(spark, sf, "documents").select("source", "text", "lang")
    rows_in = aggregates.rows_per(docs, ["source"], "rows_in")
    rows_out = aggregates.rows_per(dedup.dedup_rows(docs), ["source"], "rows_out")
    return rows_in.join(rows_out, "source").withColumn("status", F.lit("success"))


def manifest_totals(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.status_totals(ingest_manifest(spark, sf))


def column_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Per source: is a column numeric throughout, has it numbers at all."""
    from tickerloom.operators.roles import profile

    rows = table(spark, sf, "documents").select(
        "source", "lang", F.col("n_chars").cast("string").alias("n_chars"),
        F.nullif(F.col("doc_id").cast("string"), F.lit("7")).alias("doc_id"))
    return profile(rows, ["source"], ["lang", "n_chars", "doc_id"])


QUERIES = {
    "dedup_rows": dedup_rows,
    "dedup_per_file": dedup_per_file,
    "dedup_keep_unlabelled": dedup_keep_unlabelled,
    "first_seen": first_seen,
    "first_seen_text": first_seen_text,
    "top_k_per_group": top_k_per_group,
    "search_terms": search_terms,
    "keyword_match": keyword_match,
    "unpivot_wide": unpivot_wide,
    "text_choice": text_choice,
    "resume_anti_join": resume_anti_join,
    "skip_completed": skip_completed,
    "saved_per_group": saved_per_group,
    "ingest_manifest": ingest_manifest,
    "manifest_totals": manifest_totals,
    "column_profile": column_profile,
}

_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), lambda w: w <> '')"
_MANIFEST = """
SELECT i.source, i.rows_in, o.rows_out, 'success' AS status
FROM (SELECT source, count(*) AS rows_in FROM documents GROUP BY 1) i
JOIN (SELECT source, count(*) AS rows_out
      FROM (SELECT DISTINCT source, text, lang FROM documents) GROUP BY 1) o
  ON i.source = o.source"""

_KEYWORD_ROWS = ", ".join(f"({i}, '{k}')" for i, k in enumerate(KEYWORDS))


def _profile_sql(name: str) -> str:
    return (f"count({name}) AS {name}__non_null, "
            f"count(TRY_CAST({name} AS DOUBLE)) AS {name}__numeric")


ORACLES = {
    "dedup_rows": "SELECT DISTINCT text, lang FROM documents",
    "dedup_per_file": "SELECT DISTINCT source, text, lang FROM documents",
    "dedup_keep_unlabelled": """
WITH src AS (
  SELECT d.text, d.lang, CAST(l.quality AS VARCHAR) AS sentiment
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT DISTINCT text, lang, sentiment FROM src WHERE sentiment IS NOT NULL
UNION ALL SELECT text, lang, sentiment FROM src WHERE sentiment IS NULL""",
    "first_seen": r"""
WITH src AS (
  SELECT page_id, url,
         regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', '') AS address
  FROM pages),
parts AS (
  SELECT page_id, url, split_part(address, '/', 1) AS host,
         address
  FROM src)
SELECT * FROM parts
QUALIFY row_number() OVER (PARTITION BY address ORDER BY page_id) = 1""",
    "first_seen_text": """
SELECT min(doc_id) AS doc_id, sha256(text) AS digest FROM documents GROUP BY text""",
    "top_k_per_group": """
SELECT event_id, event_type, user_id, value,
       row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rank
FROM events QUALIFY rank <= 50""",
    "search_terms": f"""
SELECT c_custkey AS ticker, c_name AS company_name, kw_idx, keyword,
       '"' || c_name || '" ' || keyword AS search_term
FROM customer CROSS JOIN (VALUES {_KEYWORD_ROWS}) k(kw_idx, keyword)""",
    "keyword_match": f"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
companies AS (SELECT item_id AS ticker, w[1] || ' ' || w[2] AS phrase FROM b),
keywords AS (SELECT CAST(min(item_id) AS INTEGER) AS kw_idx, w[3] AS word FROM b GROUP BY w[3]),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
singles AS (SELECT DISTINCT doc_id, w[i] AS word FROM pos),
pairs AS (SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] AS phrase FROM pos WHERE i < len(w))
SELECT DISTINCT p.doc_id, c.ticker, k.kw_idx
FROM pairs p JOIN companies c ON p.phrase = c.phrase
JOIN singles s ON s.doc_id = p.doc_id JOIN keywords k ON k.word = s.word""",
    "unpivot_wide": """
WITH wide AS (
  SELECT o_orderkey AS date, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
         CAST(o_custkey AS VARCHAR) AS o_custkey
  FROM orders)
SELECT date, text, count(*) AS n
FROM (UNPIVOT wide ON o_orderstatus, o_orderpriority, o_custkey INTO NAME src VALUE text)
GROUP BY 1, 2""",
    "text_choice": r"""
WITH src AS (
  SELECT d.doc_id,
         CASE WHEN quality = 1 AND length(trim(text, chr(10) || chr(9) || chr(13) || ' ')) > 300
              THEN trim(text, chr(10) || chr(9) || chr(13) || ' ')
              ELSE coalesce(source, '') || ' | ' || coalesce(lang, 'Unknown Source') || ' | '
                || CASE WHEN toxic = 1 THEN coalesce(text, '') ELSE '' END END AS news_text
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT doc_id, news_text FROM src
WHERE length(news_text) > 50""",
    "resume_anti_join": r"""
SELECT doc_id, text AS input FROM documents
WHERE regexp_matches(text, '\S') AND text NOT IN (
  SELECT d.text FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE d.text IS NOT NULL)""",
    "skip_completed": """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (
  SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_totalprice > 450000)""",
    "saved_per_group": """
SELECT s_suppkey AS ticker, count(o_orderkey) AS saved
FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey
LEFT JOIN orders ON o_orderkey = l_orderkey
GROUP BY 1""",
    "ingest_manifest": _MANIFEST,
    "manifest_totals": f"""
SELECT count(*) AS total, count(*) FILTER (status = 'success') AS success,
       count(*) FILTER (status = 'failed') AS failed,
       CAST(sum(rows_in) AS BIGINT) AS rows_in, CAST(sum(rows_out) AS BIGINT) AS rows_out
FROM ({_MANIFEST})""",
    "column_profile": f"""
SELECT source, count(*) AS n_rows, {_profile_sql('lang')}, {_profile_sql('n_chars')},
       {_profile_sql('doc_id')}
FROM (SELECT source, lang, CAST(n_chars AS VARCHAR) AS n_chars,
             nullif(CAST(doc_id AS VARCHAR), '7') AS doc_id FROM documents)
GROUP BY source""",
}
