"""Which articles mention which company together with which keyword.

A search is a quoted company phrase plus a keyword. Both are matched as whole
words in any case. The phrases are measured. Up to a bound they become an automaton
(a trie of words with failure links) that walks each text once, so only what is
found becomes a row. More phrases are joined by equality to a document's word runs;
nothing is compared pairwise.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.naming import col

# Phrases of up to this many bytes, with ROW_BYTES on top of each, become an automaton
# in every worker (some ten times as large), or are broadcast.
AUTOMATON_BYTES = 8 << 20
BROADCAST_BYTES = 32 << 20
ROW_BYTES = 128

_BETWEEN = r"[^\p{L}\p{N}_]+"


def words_of(text: Column) -> Column:
    """Lower-cased words in order."""
    return F.filter(F.split(F.lower(text), _BETWEEN), lambda w: w != "")


def phrase_key(text: Column) -> Column:
    """A phrase in the form word runs have: words joined by one blank."""
    return F.array_join(words_of(text), " ")


def word_runs(words: Column, lengths: Sequence[int]) -> Column:
    """All distinct runs of the given lengths."""
    def runs(n: int) -> Column:
        if n == 1:
            return words
        last = F.size(words) - (n - 1)
        starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))

    return F.array_distinct(F.concat(*[runs(n) for n in lengths]))


class PhraseAutomaton:
    """A trie of words with failure links: finds all phrases in one walk over a text."""

    def __init__(self, phrases: Iterable[str]):
        self.steps: list[dict[str, int]] = [{}]
        self.ends: list[tuple[str, ...]] = [()]
        for phrase in phrases:
            node = 0
            for word in phrase.split(" "):
                if word not in self.steps[node]:
                    self.steps[node][word] = len(self.steps)
                    self.steps.append({})
                    self.ends.append(())
                node = self.steps[node][word]
            self.ends[node] = (phrase,)
        self.fail = [0] * len(self.steps)
        waiting = deque(self.steps[0].values())
        while waiting:
            node = waiting.popleft()
            for word, child in self.steps[node].items():
                back = self.fail[node]
                while back and word not in self.steps[back]:
                    back = self.fail[back]
                self.fail[child] = self.steps[back].get(word, 0)
                waiting.append(child)
            self.ends[node] += self.ends[self.fail[node]]
        self.words = {word for step in self.steps for word in step}

    def found(self, words: Sequence[str]) -> set[str]:
        """The phrases among ``words``; words of no phrase cost one lookup."""
        steps, ends, known = self.steps, self.ends, self.words
        out: set[str] = set()
        node = 0
        for word in words:
            if word not in known:
                node = 0
                continue
            while node and word not in steps[node]:
                node = self.fail[node]
            node = steps[node].get(word, 0)
            if ends[node]:
                out.update(ends[node])
        return out


def _walked(docs: DataFrame, doc_key: str, text: str, phrases: list[str]) -> DataFrame:
    """(doc_key, __phrase) for the distinct phrases of each text."""
    spaced = docs.select(col(doc_key), F.regexp_replace(
        F.lower(col(text)), _BETWEEN, " ").alias("__words"))
    schema = spaced.withColumnRenamed("__words", "__phrase").schema

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        automaton = PhraseAutomaton(phrases)
        for batch in batches:
            places, hits = [], []
            for place, words in enumerate(batch.column(1).to_pylist()):
                found = automaton.found(words.split(" ")) if words else ()
                places.extend([place] * len(found))
                hits.extend(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(places, pa.int64())), pa.array(hits, pa.string())],
                names=[doc_key, "__phrase"])

    return spaced.mapInArrow(run, schema)


def matched_phrases(docs: DataFrame, doc_key: str, text: str, phrases: DataFrame,
                    phrase: str) -> DataFrame:
    """(doc_key, phrase columns) for every phrase a document contains."""
    keyed = phrases.withColumn("__phrase", phrase_key(col(phrase))).where("__phrase <> ''")
    sizes = keyed.groupBy(F.size(F.split("__phrase", " ")).alias("n")).agg(
        F.sum(F.octet_length("__phrase") + ROW_BYTES).alias("bytes")).collect()
    lengths = sorted(r.n for r in sizes)  # a few phrase lengths
    measured = sum(r.bytes or 0 for r in sizes)
    if measured <= AUTOMATON_BYTES:
        known = [r[0] for r in keyed.select("__phrase").distinct().collect()]
        runs = _walked(docs, doc_key, text, sorted(known))
    else:
        runs = docs.select(doc_key, words_of(col(text)).alias("__words")).select(
            doc_key, F.explode(word_runs(F.col("__words"), lengths or [1])).alias("__phrase"))
    small = measured <= BROADCAST_BYTES
    return runs.join(F.broadcast(keyed) if small else keyed, "__phrase").drop("__phrase")


def match_news(docs: DataFrame, companies: DataFrame, keywords: DataFrame,
               doc_key: str = "doc_id", text: str = "text",
               first_keyword: bool = False) -> DataFrame:
    """(doc_key, ticker, kw_idx) for articles with the company and the keyword.

    ``first_keyword`` gives the smallest ``kw_idx`` only, instead of all of them.

    One pass finds both kinds. Matches are gathered per document, where their
    number is bounded by the document's own words.
    """
    terms = companies.select(
        F.lit(0).alias("__kind"), F.col("ticker").cast("string").alias("__id"),
        F.col("company_name").alias("__term")
    ).unionByName(keywords.select(
        F.lit(1).alias("__kind"), F.col("kw_idx").cast("string").alias("__id"),
        F.col("keyword").alias("__term")))
    found = matched_phrases(docs, doc_key, text, terms, "__term")
    per_doc = found.groupBy(doc_key).agg(
        F.collect_set(F.when(F.col("__kind") == 0, F.col("__id"))).alias("__companies"),
        F.collect_set(F.when(F.col("__kind") == 1, F.col("__id"))).alias("__keywords"),
    ).where((F.size("__companies") > 0) & (F.size("__keywords") > 0))
    ticker_type = companies.schema["ticker"].dataType
    numbers = F.transform("__keywords", lambda k: k.cast("int"))
    return (
        per_doc.select(doc_key, F.explode("__companies").alias("ticker"), numbers.alias("__kw"))
        .select(doc_key, F.col("ticker").cast(ticker_type).alias("ticker"),
                (F.array_min("__kw") if first_keyword else F.explode("__kw")).alias("kw_idx"))
    )
