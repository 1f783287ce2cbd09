"""Prompt, chat and token queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.catalog.labels import BLOCK_SQL, block_text
from tickerloom.catalog.tables import table
from tickerloom.operators import chat as C
from tickerloom.operators import filters
from tickerloom.operators import tokens as T
from tickerloom.plans.token_set import token_dataset

KEYS = ["conv_id"]


def prompt_build(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("input"))
    prompts = C.build_prompts(filters.non_blank(docs, "input"))
    return prompts.select("doc_id", F.get("messages", F.lit(0))["content"].alias("system"),
                          F.get("messages", F.lit(1))["role"].alias("role"),
                          F.get("messages", F.lit(1))["content"].alias("prompt"))


def conversations(spark: SparkSession, sf: str) -> DataFrame:
    """Every conversation with all its turns, of any role, in order."""
    turns = table(spark, sf, "conversations").where("role is not null and text is not null")
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return turns.groupBy("conv_id").agg(ordered.alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(
            t["role"].alias("role"), t["content"].alias("content"))).alias("messages"))


def chat_messages(spark: SparkSession, sf: str) -> DataFrame:
    labelled = block_text(spark, sf).select("doc_id", F.col("text").alias("input"), "output")
    chats = C.to_chat_messages(filters.well_formed(labelled))
    parts = [F.get("messages", F.lit(i))["content"].alias(name)
             for i, name in enumerate(["system", "user", "assistant"])]
    roles = F.array_join(F.col("messages.role"), ",").alias("roles")
    return chats.select("doc_id", roles, *parts)


def conversation_chats(spark: SparkSession, sf: str) -> DataFrame:
    return conversations(spark, sf).select(
        *KEYS, C.render_chat(F.col("messages")).alias("text"))


def render_chat(spark: SparkSession, sf: str) -> DataFrame:
    return conversation_chats(spark, sf)


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return T.vocabulary(T.token_rows(conversation_chats(spark, sf), KEYS, "text"))


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    chats = conversation_chats(spark, sf)
    vocab = T.vocabulary(T.token_rows(chats, KEYS, "text"))
    return T.encode_texts(chats, vocab, KEYS, "text")


def token_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """The token data set of the conversations."""
    return token_dataset(conversations(spark, sf), KEYS).select(
        *KEYS, "chunk_no", F.size("input_ids").alias("n_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"),
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("ids"))


def document_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents, most of them several slices long."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    vocab = T.vocabulary(T.token_rows(docs, ["doc_id"], "text"))
    chunks = T.encode_texts(docs, vocab, ["doc_id"], "text")
    return chunks.select("doc_id", "chunk_no", F.size("input_ids").alias("n_ids"),
                         F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("ids"))


def pad_batches(spark: SparkSession, sf: str) -> DataFrame:
    keys = [*KEYS, "chunk_no"]
    sizes = T.chunk_sizes(conversation_chats(spark, sf), KEYS, "text")
    return T.pad_batches(_chunks(spark, sf), keys, sizes=sizes).select(
        *keys, "batch_id", "n_ids", "batch_len",
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"),
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("ids"),
        F.array_join(F.col("labels").cast("array<string>"), " ").alias("labels"))


QUERIES = {
    "prompt_build": prompt_build,
    "chat_messages": chat_messages,
    "render_chat": render_chat,
    "vocabulary": vocabulary,
    "token_chunks": token_chunks,
    "document_chunks": document_chunks,
    "pad_batches": pad_batches,
}


def quoted_sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SYSTEM = quoted_sql(C.SYSTEM_PROMPT)
_CHATS = """
chats AS (
  SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10),
                             '' ORDER BY turn, role, text) AS text
  FROM conversations WHERE role IS NOT NULL AND text IS NOT NULL GROUP BY conv_id)"""


def _token_sql(source: str, keys: str) -> str:
    return f"""
lists AS (SELECT {keys}, regexp_extract_all(text, '{T.TOKEN}', 1) AS t FROM {source}),
tokens AS (SELECT {keys}, unnest(t) AS token, unnest(range(len(t))) AS pos FROM lists),
vocab AS (
  SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) - 1 AS INTEGER) AS id, n
  FROM (SELECT token, count(*) AS n FROM tokens GROUP BY token)),
chunks AS (
  SELECT {keys}, CAST(pos // {T.MAX_LENGTH} AS INTEGER) AS chunk_no,
         list(id ORDER BY pos) AS ids
  FROM tokens JOIN vocab USING (token) GROUP BY ALL)"""


_CONVERSATION_TOKENS = f"{_CHATS}, {_token_sql('chats', 'conv_id')}"

ORACLES = {
    "prompt_build": rf"""
SELECT doc_id, {_SYSTEM} AS system, 'user' AS role,
       'Analyze this text:' || chr(10) || chr(10) || text AS prompt
FROM documents WHERE regexp_matches(text, '\S')""",
    "chat_messages": f"""
WITH blocks AS ({BLOCK_SQL})
SELECT doc_id, 'system,user,assistant' AS roles, {_SYSTEM} AS system,
       text AS "user", output AS assistant
FROM blocks WHERE contains(output, 'Sentiment:') AND contains(output, 'Decision:')""",
    "render_chat": f"WITH {_CHATS} SELECT * FROM chats",
    "vocabulary": f"WITH {_CONVERSATION_TOKENS} SELECT token, id AS token_id, n FROM vocab",
    "token_chunks": f"""WITH {_CONVERSATION_TOKENS}
SELECT conv_id, chunk_no, CAST(len(ids) AS INTEGER) AS n_ids,
       CAST(len(ids) AS INTEGER) AS mask_sum, array_to_string(ids, ' ') AS ids
FROM chunks""",
    "document_chunks": f"""WITH {_token_sql('documents', 'doc_id')}
SELECT doc_id, chunk_no, CAST(len(ids) AS INTEGER) AS n_ids, array_to_string(ids, ' ') AS ids
FROM chunks""",
    "pad_batches": f"""WITH {_CONVERSATION_TOKENS},
numbered AS (
  SELECT *, (row_number() OVER (ORDER BY conv_id, chunk_no) - 1) // {T.BATCH_SIZE}
            AS batch_id
  FROM chunks),
sized AS (
  SELECT *, CAST(len(ids) AS INTEGER) AS n_ids,
         CAST(max(len(ids)) OVER (PARTITION BY batch_id) AS INTEGER) AS batch_len
  FROM numbered)
SELECT conv_id, chunk_no, batch_id, n_ids, batch_len, n_ids AS mask_sum,
       array_to_string(ids, ' ') || repeat(' 0', batch_len - n_ids) AS ids,
       array_to_string(ids, ' ') || repeat(' {T.IGNORED_LABEL}', batch_len - n_ids) AS labels
FROM sized""",
}
