"""Prompts, chat messages and their rendered text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickerloom.operators.columns import truncate
from tickerloom.operators.filters import well_formed

# --- fixed values -----------------------------------------------------------
PROMPT_LEAD = "Analyze this text:\n\n"
START, END = "<|im_start|>", "<|im_end|>"
# Digests that are broadcast to pick a batch's outputs: about 16 MB.
FEW_DIGESTS = 250_000

SYSTEM_PROMPT = """You are a Senior Portfolio Manager and Quantitative Analyst at a top-tier hedge fund. Your task is to analyze financial news/reports and provide a structured, high-signal assessment.

### ANALYTICAL PROCESS (INTERNAL STEPS):
1. **Analyze**: Identify the core event (Earnings, Merger, Macro, Product Launch, Regulation).
2. **Rethink**: Look for nuance. Does a "beat" in earnings hide weak guidance? Is the news already priced in? Are there contradictory signals in the text?
3. **Evaluate**: Assess the credibility of the signal. Is this a short-term noise or a long-term fundamental shift?
4. **Synthesize**: Formulate a "Bullish", "Bearish", or "Neutral" stance with a confidence score (0.0 to 1.0).

### OUTPUT FORMAT (STRICT):
You must output the final analysis in the following key-value format. Do not use Markdown code blocks or introduction text. Just the raw block.

Sentiment: [Bullish/Bearish/Neutral]
Confidence: [0.0 - 1.0]
Impact: [Strong/Medium/Weak]
Horizon: [Short/Medium/Long]
Event: [Brief Category, e.g., Earnings, Geopolitics]
Summary: [A dense, professional paragraph summarizing the "Why". Mention specific tickers, numbers, and the rationale for the sentiment. Focus on the causal link between the event and the price action.]
Decision: [BUY/SELL/HOLD]
"""
# ----------------------------------------------------------------------------

MESSAGES_TYPE = "array<struct<role:string,content:string>>"


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def prompt_text(text: Column, max_chars: int | None = None) -> Column:
    return F.concat(F.lit(PROMPT_LEAD), truncate(text, max_chars))


def build_prompts(df: DataFrame, text: str = "input", system: str = SYSTEM_PROMPT,
                  max_chars: int | None = None) -> DataFrame:
    """Adds ``messages``: the system prompt and the text (its start, if asked) to analyse."""
    return df.withColumn("messages", F.array(
        message("system", F.lit(system)), message("user", prompt_text(F.col(text), max_chars))))


def to_chat_messages(df: DataFrame, user: str = "input", assistant: str = "output",
                     system: str = SYSTEM_PROMPT) -> DataFrame:
    """One system / user / assistant array per row; both texts must be there."""
    return df.dropna(subset=[user, assistant]).withColumn("messages", F.array(
        message("system", F.lit(system)), message("user", F.col(user)),
        message("assistant", F.col(assistant))))


def render_chat(messages: Column) -> Column:
    """The messages as one marked-up text, in array order."""
    return F.array_join(F.transform(messages, lambda m: F.concat(
        F.lit(START), m["role"], F.lit("\n"), m["content"], F.lit(END + "\n"))), "")


def label_batches(df: DataFrame, label: Callable[[pd.Series], pd.Series],
                  text: str = "input", max_chars: int | None = None) -> DataFrame:
    """Adds ``output`` from a caller's batch function; malformed ones are dropped.

    ``label`` gets the prompt texts of one Arrow batch and returns as many
    responses, null where it failed.
    """
    schema = StructType([*df.schema.fields, StructField("output", StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prompts = PROMPT_LEAD + batch[text].str.slice(0, max_chars)
            yield batch.assign(output=label(prompts))

    return well_formed(df.mapInPandas(run, schema))


def known_outputs(responses: DataFrame, text: str = "input") -> DataFrame:
    """(digest, output) of a table of (text, output) responses, one row per text.

    A text with several responses gets the smallest, to stay repeatable.
    """
    known = responses.select(F.unhex(F.sha2(F.col(text), 256)).alias("__digest"), "output")
    return well_formed(known).groupBy("__digest").agg(F.min("output").alias("output"))


def label_from_known(df: DataFrame, known: DataFrame, text: str = "input") -> DataFrame:
    """Adds ``output`` from ``known_outputs``.

    Joined on digests, so the long text is shuffled with the input rows only. The
    digests of a batch are counted; if few, they pick its outputs before the shuffle,
    so many batches do not shuffle all outputs each.
    """
    asked = df.withColumn("__digest", F.unhex(F.sha2(F.col(text), 256)))
    digests = asked.select("__digest").distinct()
    if digests.count() <= FEW_DIGESTS:
        known = known.join(F.broadcast(digests), "__digest", "left_semi")
    return asked.join(known, "__digest").drop("__digest")


def label_from_table(df: DataFrame, responses: DataFrame, text: str = "input") -> DataFrame:
    """Adds ``output`` from a table of (text, output) responses."""
    return label_from_known(df, known_outputs(responses, text), text)
