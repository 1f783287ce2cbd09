"""Token counts by a library tokenizer: batches in Arrow functions, lengths only.

A batch holds about equally many bytes. Long texts are split where the
tokenizer's own first split always cuts, and the counts of the parts are added.
Pieces seen before in the same worker are not encoded again.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated rows
come back repeated; columns of the input named like result columns give way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from tickerloom.llm import pieces
from tickerloom.llm.common import map_texts, table, without, worker_memo

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
RESULTS = "n_bytes long, n_tokens long, over_limit boolean"


def _byte_level(tokenizer) -> bool:
    """Whether safe places are safe for this tokenizer."""
    import json

    spec = json.loads(tokenizer.to_str())
    first = spec.get("pre_tokenizer") or {}
    return (spec.get("normalizer") is None and first.get("type") == "ByteLevel"
            and first.get("use_regex") and not first.get("add_prefix_space")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"]
                        for t in spec.get("added_tokens", [])))


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """A function from texts to their token counts, without special tokens added."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for batch in pieces.grouped(texts, len)
                              for ids in model.encode(batch, num_threads=1)]
    tokenizer = pieces.load_tokenizer(path)

    def lengths(batch: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch_fast(batch, add_special_tokens=False)]

    if not _byte_level(tokenizer):
        return lambda texts: [n for batch in pieces.grouped(texts, len) for n in lengths(batch)]
    memo = pieces.PieceMemo(lengths)
    return lambda texts: memo.apply(texts, sum, sum)


def token_counts(df: DataFrame, text: str = "text", tokenizer: str = TOKENIZER,
                 limit: int = LIMIT, keep: Iterable[str] | None = None) -> DataFrame:
    """``keep`` (all columns but the text), ``n_bytes``, ``n_tokens``, ``over_limit``."""
    path = pieces.vocabulary(tokenizer)
    keep = without(df, [text, "n_bytes", "n_tokens", "over_limit"]).columns if keep is None \
        else keep

    def rows():
        count = worker_memo(f"counter {path}", lambda: counter(path))

        def work(texts: list[str]) -> dict:
            tokens = count(texts)
            return {"n_bytes": [len(t.encode()) for t in texts], "n_tokens": tokens,
                    "over_limit": [n > limit for n in tokens]}

        return work

    return map_texts(df, text, RESULTS, rows, keep)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), keep=["doc_id"])


QUERIES = {"op2_token_counts": op2_token_counts}
ORACLES: dict[str, str] = {}
