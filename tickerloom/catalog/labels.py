"""Label queries: numeric codes, title case, label blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.catalog.tables import table
from tickerloom.functions import labels as L
from tickerloom.operators import filters


def title_labels(spark: SparkSession, sf: str) -> DataFrame:
    kinds = table(spark, sf, "events").select(
        F.lit("event_type").alias("source"), F.col("event_type").alias("label"))
    priorities = table(spark, sf, "orders").select(
        F.lit("o_orderpriority").alias("source"),
        F.concat(F.lit(" very-"), F.lower("o_orderpriority"), F.lit(" ")).alias("label"))
    every = kinds.unionByName(priorities).withColumn("title", L.title_case(F.col("label")))
    return every.groupBy("source", "label", "title").agg(F.count("*").alias("n"))


def numeric_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    code = (F.col("quality") - F.col("toxic")).cast("double")
    return table(spark, sf, "labels").select(
        "doc_id", L.map_numeric_sentiment(code).alias("sentiment"),
        L.map_numeric_sentiment(F.concat(F.col("quality"), F.lit(".50"))).alias("unmapped"))


def block_text(spark: SparkSession, sf: str) -> DataFrame:
    """A label block per labelled document; toxic ones lack the decision."""
    good = F.col("quality") == 1
    lines: list[Column] = [
        F.concat(F.lit("Sentiment: "), F.when(good, "Bullish").otherwise("Bearish")),
        F.concat(F.lit("Confidence: "),
                 F.when(good, F.concat(F.lit("0."), F.col("n_chars"))).otherwise("high")),
        F.lit("Impact:  Medium "), F.lit("Horizon: Short"),
        F.concat(F.lit("Event: "), F.col("source")),
        F.concat(F.lit("Summary: "), F.translate("text", "\n\r", "  ")),
    ]
    tail = F.when(F.col("toxic") == 0, "\nDecision: BUY").otherwise("")
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return rows.select("doc_id", "text", F.concat(F.concat_ws("\n", *lines), tail).alias("output"))


def label_block_parse(spark: SparkSession, sf: str) -> DataFrame:
    blocks = filters.well_formed(block_text(spark, sf))
    fields = L.label_block_columns(F.col("output"))
    return blocks.select("doc_id", *[c.alias(n) for n, c in fields.items()])


QUERIES = {
    "title_labels": title_labels,
    "numeric_sentiment": numeric_sentiment,
    "label_block_parse": label_block_parse,
}

BLOCK_SQL = """
SELECT d.doc_id, d.text,
       'Sentiment: ' || CASE WHEN quality = 1 THEN 'Bullish' ELSE 'Bearish' END || chr(10)
       || 'Confidence: ' || CASE WHEN quality = 1 THEN '0.' || n_chars ELSE 'high' END || chr(10)
       || 'Impact:  Medium ' || chr(10) || 'Horizon: Short' || chr(10)
       || 'Event: ' || source || chr(10)
       || 'Summary: ' || translate(d.text, chr(10) || chr(13), '  ')
       || CASE WHEN toxic = 0 THEN chr(10) || 'Decision: BUY' ELSE '' END AS output
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


def _field(key: str) -> str:
    return f"nullif(trim(regexp_extract(output, '(?m)^{key}:[ \\t]*(.*)$', 1)), '')"


ORACLES = {
    "title_labels": r"""
WITH src AS (
  SELECT 'event_type' AS source, event_type AS label FROM events
  UNION ALL
  SELECT 'o_orderpriority', ' very-' || lower(o_orderpriority) || ' ' FROM orders)
SELECT source, label,
       array_to_string(list_transform(
         regexp_extract_all(trim(label), '(\p{L}+|\P{L}+)'),
         lambda x: upper(x[1:1]) || lower(x[2:])), '') AS title,
       count(*) AS n
FROM src GROUP BY ALL""",
    "numeric_sentiment": """
SELECT doc_id,
       CASE quality - toxic WHEN -1 THEN 'Negative' WHEN 0 THEN 'Neutral'
            WHEN 1 THEN 'Positive' END AS sentiment,
       quality || '.50' AS unmapped
FROM labels""",
    "label_block_parse": f"""
WITH blocks AS ({BLOCK_SQL})
SELECT doc_id, {_field('Sentiment')} AS sentiment,
       TRY_CAST({_field('Confidence')} AS DOUBLE) AS confidence,
       {_field('Impact')} AS impact, {_field('Horizon')} AS horizon,
       {_field('Event')} AS event, {_field('Summary')} AS summary,
       {_field('Decision')} AS decision
FROM blocks
WHERE contains(output, 'Sentiment:') AND contains(output, 'Decision:')""",
}
