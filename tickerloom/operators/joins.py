"""Resume joins and the search-term product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.naming import col


def search_term(company: Column, keyword: Column) -> Column:
    return F.format_string('"%s" %s', company, keyword)


def search_terms(companies: DataFrame, keywords: list[tuple[int, str]]) -> DataFrame:
    """Every company with every keyword, as a quoted search phrase.

    The keyword list is a fixed handful, so it is expanded inside each company
    row instead of being joined.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("kw_idx"), F.lit(k).alias("keyword"))
                      for i, k in keywords])
    return (
        companies.withColumn("__kw", F.explode(pairs))
        .select(*companies.columns, "__kw.kw_idx", "__kw.keyword")
        .withColumn("search_term", search_term(F.col("company_name"), F.col("keyword")))
    )


def skip_completed(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items whose key is not in the progress list."""
    return items.join(done.select(key).distinct(), key, "left_anti")


def skip_labelled(inputs: DataFrame, labelled: DataFrame, text: str = "input") -> DataFrame:
    """Inputs whose exact text has no label yet; copies among them all stay.

    The labelled side is reduced to SHA-256 digests before the shuffle, so long
    texts travel only once, with the input row.
    """
    done = labelled.select(F.sha2(col(text), 256).alias("__digest")).distinct()
    return (
        inputs.withColumn("__digest", F.sha2(col(text), 256))
        .join(done, "__digest", "left_anti").drop("__digest")
    )
