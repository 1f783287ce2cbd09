"""Quality rules: word and line rules of a text, and line frequency across documents.

Everything runs in built-in column functions. Lines are normalised (lower case,
runs of white space as one space, trimmed) and hashed. For every host and line the
distinct documents that hold it are counted; a line in more than ``MAX_DOCUMENTS``
of them is over the limit. Lines over the limit are removed, and a document is
rejected if too few words remain.

Documents are distinct if their texts differ. A caller who knows more, such as the
components of near duplicates, names a column of identities instead, so that the
many copies of one document do not make boilerplate of its lines.

Defined results: a null text has no words and fails the base rules; a null host
is a host of its own; repeated rows come back repeated; input columns named like
result columns give way; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm.common import arrow_ready, table, without

MAX_DOCUMENTS = 10  # documents of a host that may hold a line
LEAST_PERCENT = 30  # words that have to remain
WHITE = r"[\x20\x09-\x0D]+"

RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "base_failed", "n_removed_words", "kept"]


def normal(line: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(line, WHITE, " ")))


def line_hash(line: Column) -> Column:
    """60 bits of a digest of the normalised line."""
    return F.conv(F.substring(F.md5(normal(line)), 1, 15), 16, 10).cast("long")


def words(text: Column) -> Column:
    return F.filter(F.split(text, WHITE), lambda w: w != "")


def base_measures(df: DataFrame, text: str, keep: Iterable[str]) -> DataFrame:
    """``keep``, the counts of the base rules, and the hashes of the text's lines.

    Words in repeated windows: window hashes are sorted with their places; equal
    neighbours are repeated windows, and the words under their places are counted
    once each. A window is a 64-bit hash of three word hashes.
    """
    text_column = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = df.select(*[F.col(f"`{c}`") for c in keep], text_column.alias("__text"))
    df = df.withColumns({
        "__words": words(F.col("__text")),
        "__lines": F.filter(F.split("__text", "\n"), lambda x: F.length(normal(x)) > 0)})
    df = df.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "n_symbols": F.regexp_count("__text", F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__lines": F.transform("__lines", lambda x: F.struct(
            line_hash(x).alias("line"), F.size(words(x)).alias("words"))),
        "__digest": F.unhex(F.md5("__text")),
        "__hashes": F.transform("__words", lambda w: F.xxhash64(w))}).drop("__text", "__words")
    df = df.withColumn("__windows", F.expr(
        "if(n_words < 3, array(), transform(sequence(0, size(__hashes) - 3), i -> "
        "xxhash64(__hashes[i], __hashes[i + 1], __hashes[i + 2])))")).drop("__hashes")
    df = df.withColumn("__sorted", F.expr(
        "if(size(array_distinct(__windows)) = size(__windows), "
        "array(), array_sort(transform(__windows, (h, i) -> named_struct('h', h, 'i', i))))"
    )).drop("__windows")
    df = df.withColumn("__places", F.expr(
        "sort_array(transform(filter(__sorted, (x, j) -> "
        "(j > 0 and __sorted[greatest(j - 1, 0)].h = x.h) or (j < size(__sorted) - 1 "
        "and __sorted[least(j + 1, size(__sorted) - 1)].h = x.h)), x -> x.i))")).drop("__sorted")
    df = df.withColumn("n_repeat_words", F.expr(
        "aggregate(__places, named_struct('n', 0L, 'last', -3), (a, p) -> "
        "named_struct('n', a.n + least(3, p - a.last), 'last', p), a -> a.n)")).drop("__places")
    return df.withColumn("base_failed", F.expr(
        "n_words < 50 or 100 * n_repeat_words > 50 * n_words"))


def frequent_lines(base: DataFrame, max_documents: int, by_identity: bool) -> DataFrame:
    """(host, line) of lines in more than ``max_documents`` distinct documents of the host.

    Copies of a text collapse before lines become rows; lines of a document count
    once, also where several texts are one document.
    """
    texts = base.dropDuplicates(["__host", "__digest", "__identity"])
    held = texts.select(F.col("__host").alias("host"), "__identity", F.explode(
        F.array_distinct(F.transform("__lines", lambda x: x["line"]))).alias("line"))
    if by_identity:
        held = held.distinct()
    return (held.groupBy("host", "line").agg(F.count("*").alias("n"))
            .where(F.col("n") > max_documents).select("host", "line"))


def measured(df: DataFrame, text: str, host: str, keep: Iterable[str], max_documents: int,
             least_percent: int, identity: str | None) -> tuple[DataFrame, DataFrame]:
    """Verdicts by row id, and (row id, line) of the lines over the limit."""
    arrow_ready(df.sparkSession)
    df = df.withColumns({
        "__host": F.coalesce(F.col(f"`{host}`"), F.lit("\0")),
        "__identity": F.lit("") if identity is None else F.col(f"`{identity}`")})
    base = (base_measures(df, text, [*keep, "__host", "__identity"])
            .withColumn("__row", F.monotonically_increasing_id()).checkpoint())
    lines = (base.select("__row", F.col("__host").alias("host"), F.explode("__lines").alias("one"))
             .select("__row", "host", F.col("one.line").alias("line"),
                     F.col("one.words").alias("words")))
    over = lines.join(frequent_lines(
        base.select("__host", "__digest", "__identity", "__lines"), max_documents,
        identity is not None), ["host", "line"])
    removed = over.groupBy("__row").agg(F.sum("words").cast("long").alias("removed"))
    verdicts = (base.drop("__lines", "__host", "__digest", "__identity").join(removed, "__row", "left")
                .withColumn("n_removed_words", F.coalesce("removed", F.lit(0).cast("long")))
                .drop("removed")
                .withColumn("kept", F.expr(
                    f"not base_failed and 100 * (n_words - n_removed_words) "
                    f">= {least_percent} * n_words")))
    return verdicts, over.select("__row", "line")


def quality_rules(df: DataFrame, text: str = "text", host: str = "source",
                  keep: Iterable[str] | None = None, max_documents: int = MAX_DOCUMENTS,
                  least_percent: int = LEAST_PERCENT, identity: str | None = None) -> DataFrame:
    """``keep`` (all columns but the text), the measures and ``kept``.

    ``identity`` names a column that tells documents apart; a null one is one document.
    """
    keep = without(df, [text, *RESULTS]).columns if keep is None else list(keep)
    verdicts, _ = measured(df, text, host, keep, max_documents, least_percent, identity)
    return verdicts.select(*[F.col(f"`{c}`") for c in keep], *RESULTS)


def kept_documents(df: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source",
                   max_documents: int = MAX_DOCUMENTS,
                   least_percent: int = LEAST_PERCENT, identity: str | None = None) -> DataFrame:
    """The documents that pass, without their lines over the limit.

    Rows are told apart by id and text, so equal rows share one verdict.
    """
    mark = F.xxhash64(F.col(f"`{id}`"), F.col(f"`{text}`"))
    marked = df.withColumn("__mark", mark)
    verdicts, over = measured(marked, text, host, ["__mark"], max_documents, least_percent,
                              identity)
    bad = over.groupBy("__row").agg(F.collect_set("line").alias("__bad"))
    passed = (verdicts.where("kept").join(bad, "__row", "left").select("__mark", "__bad")
              .dropDuplicates(["__mark"]))
    cleaned = F.array_join(F.filter(
        F.split(F.col(f"`{text}`"), "\n"),
        lambda x: (F.length(normal(x)) == 0) | ~F.array_contains("__bad", line_hash(x))), "\n")
    return (marked.join(passed, "__mark")
            .withColumn(text, F.when(F.col("__bad").isNull(), F.col(f"`{text}`"))
                        .otherwise(cleaned)).select(*[F.col(f"`{c}`") for c in df.columns]))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), keep=["doc_id"])


QUERIES = {"op1_quality_rules": op1_quality_rules}
ORACLES = {"op1_quality_rules": rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(0)) AS host,
         coalesce(text, '') AS t FROM documents),
parts AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
         list_filter(string_split(t, chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM docs),
windows AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM parts)),
repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows)
  WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY r),
lines AS (
  SELECT r, host, x, len(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'),
                                     lambda w: w <> '')) AS n,
         ('0x' || substr(md5(trim(lower(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g')))), 1, 15))
         ::BIGINT AS line
  FROM (SELECT r, host, unnest(ls) AS x FROM parts)),
frequent AS (
  SELECT host, line FROM (SELECT DISTINCT host, t, line FROM lines JOIN (SELECT r, t FROM docs) USING (r))
  GROUP BY host, line HAVING count(*) > {MAX_DOCUMENTS}),
removed AS (
  SELECT r, sum(n)::BIGINT AS removed FROM lines JOIN frequent USING (host, line) GROUP BY r),
counts AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(removed, 0) AS n_removed_words
  FROM parts LEFT JOIN covered USING (r) LEFT JOIN removed USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND 100 * (n_words - n_removed_words) >= {LEAST_PERCENT} * n_words AS kept
FROM counts"""}
