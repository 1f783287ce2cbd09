"""News articles per company, labelled with their forward alpha.

Only narrow columns take part until the records are chosen: matching, ranking,
first-seen and the alpha join carry keys, dates and urls. Titles and full texts
join once at the end, for the articles that are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickerloom.functions.labels import binary_alpha_label
from tickerloom.operators import alpha as A
from tickerloom.operators import columns, filters, joins, matching, ranking
from tickerloom.operators.aggregates import kept_per_group
from tickerloom.sources import readers, runs, sinks

RECORD_COLUMNS = ["ticker", "company_name", "published_date", "news_text", "true_alpha"]


def searchable_text(title: str = "title", description: str = "description",
                    full_text: str = "full_text"):
    return F.concat_ws(" ", title, description, full_text)


def search_results(news: DataFrame, companies: DataFrame, keywords: DataFrame,
                   per_search: int | None = None) -> DataFrame:
    """(doc_id, ticker, kw_idx, url, event_date): the hits of each company.

    ``news`` has a unique ``doc_id``. Every hit counts, under its first keyword;
    with ``per_search`` a company and keyword keep their newest hits only, as a
    search service with a limit would return them.
    """
    texts = news.select("doc_id", searchable_text().alias("__text"))
    hits = matching.match_news(texts, companies, keywords, "doc_id", "__text",
                               first_keyword=per_search is None)
    results = hits.join(news.select("doc_id", "url", "event_date"), "doc_id")
    if per_search is None:
        return results
    newest = [F.col("event_date").desc_nulls_last(), F.asc_nulls_last("url"), F.asc("doc_id")]
    return ranking.top_k_per_group(results, ["ticker", "kw_idx"], newest, per_search,
                                   salt_on=["doc_id"]).drop("rank")


def first_results(results: DataFrame) -> DataFrame:
    """One hit per company and url: the first by keyword, then the newest.

    A first hit that later fails the date or alpha test still hides the others.
    """
    with_url = results.where(filters.valid_url(F.col("url"))).withColumn(
        "__age", F.coalesce(-F.unix_date("event_date"), F.lit(2**31 - 1)))
    return ranking.first_seen(with_url, ["ticker", "url"],
                              ["kw_idx", "__age", "doc_id"]).drop("__age")


def labelled_records(results: DataFrame, news: DataFrame, companies: DataFrame,
                     by_day: DataFrame) -> DataFrame:
    """The final records (with ``kw_idx``) for first hits that have an alpha."""
    dated = filters.valid_news(first_results(results))
    labelled = filters.label_available(A.next_trading_day_join(dated, by_day))
    chosen = columns.choose_text(F.col("title"), F.col("publisher"), F.col("description"),
                                 F.col("full_text"))
    payload = news.select("doc_id", chosen.alias("news_text"))
    records = filters.min_length(labelled.join(payload, "doc_id"), "news_text")
    return records.join(companies.select("ticker", "company_name"), "ticker").select(
        "ticker", "company_name",
        F.date_format("event_date", "yyyy-MM-dd").alias("published_date"),
        columns.truncate(F.col("news_text")).alias("news_text"),
        binary_alpha_label(F.col("alpha")).alias("true_alpha"), "kw_idx")


def alpha_news(news: DataFrame, prices: DataFrame, benchmark: DataFrame,
               companies: DataFrame, keywords: DataFrame,
               done: DataFrame | None = None) -> DataFrame:
    """All steps from article, price and benchmark tables to labelled records."""
    wanted = companies if done is None else joins.skip_completed(companies, done, "ticker")
    results = search_results(news, wanted, keywords)
    prices = prices.join(wanted.select("ticker"), "ticker", "left_semi")
    return labelled_records(results, news, wanted, A.alpha_by_day(prices, benchmark))


def saved_counts(records: DataFrame, companies: DataFrame, keyword_count: int) -> DataFrame:
    """Records kept per company and keyword, zeros included."""
    searches = companies.select("ticker").withColumn(
        "kw_idx", F.explode(F.sequence(F.lit(0), F.lit(keyword_count - 1))))
    return kept_per_group(searches, records, ["ticker", "kw_idx"])


def to_labelling_input(records: DataFrame) -> DataFrame:
    """Records in the form the labelling flow reads."""
    return records.withColumnRenamed("news_text", "input")


def incremental_news(spark: SparkSession, news: DataFrame, prices: DataFrame,
                     benchmark: DataFrame, companies: DataFrame, keywords: DataFrame,
                     records_path: str, checkpoint_path: str,
                     written: Callable[[], None] = lambda: None) -> DataFrame:
    """Label the companies not done yet; returns the companies of this run.

    A company is done if the checkpoint names it or the log beside the records does.
    A run that dies is repeated with the same companies into the same folder, so it
    neither loses nor doubles records; old records are not read. A company without
    records is done too. ``written`` is called between records and log.
    """
    key = companies.select("ticker").schema
    text = StructType([StructField("ticker", StringType())])

    def pending() -> DataFrame:
        done = readers.read_checkpoint(spark, checkpoint_path).unionByName(
            runs.logged(spark, records_path, text))
        return joins.skip_completed(
            companies.select(F.col("ticker").cast("string")), done, "ticker")

    run = runs.Run(spark, records_path, pending, text)
    wanted = companies.join(run.keys.select(
        F.col("ticker").cast(key["ticker"].dataType).alias("ticker")), "ticker", "left_semi")
    run.write(alpha_news(news, prices, benchmark, wanted, keywords).select(*RECORD_COLUMNS))
    written()
    sinks.overwrite_checkpoint(run.keys, f"{checkpoint_path}/run={run.run}")
    keys = run.keys.checkpoint()
    run.finish()
    return companies.join(keys.select(
        F.col("ticker").cast(key["ticker"].dataType).alias("ticker")), "ticker", "left_semi")
