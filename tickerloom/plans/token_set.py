"""From chat records to fixed-size token chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.operators import chat, tokens


def token_dataset(chats: DataFrame, keys: Sequence[str], messages: str = "messages",
                  max_length: int = tokens.MAX_LENGTH,
                  vocab: DataFrame | None = None) -> DataFrame:
    """(keys, chunk_no, input_ids, attention_mask) of every chat record.

    ``keys`` identify a record. Without ``vocab`` it is built from these chats.
    """
    rendered = chats.select(*keys, chat.render_chat(F.col(messages)).alias("text"))
    if vocab is None:
        vocab = tokens.vocabulary(tokens.token_rows(rendered, keys, "text"))
    chunks = tokens.encode_texts(rendered, vocab, keys, "text", max_length)
    return chunks.withColumn("attention_mask", tokens.attention_mask(F.col("input_ids")))
