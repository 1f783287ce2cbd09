"""Harmonic packing of token sequences into bins of a fixed capacity.

A length in (C / (k + 1), C / k] belongs to class k, and a bin of class k takes
k pieces. Documents are cut so that little is wasted: whole bins first, then the
rest is kept whole if it nearly fills its class's place, else a piece that fills
a place of the next class is cut off it. The pieces of a class are dealt to
groups of about ``GROUP`` pieces; every group fills its bins independently. The
few pieces that do not fill a class's last bin are packed first-fit, decreasing,
in groups of bounded size.

Defined results: a null text is empty, and every document ends with the end id,
so an empty one is a piece of length 1; repeated rows are packed as often as
they come; columns of the input named like result columns give way; an empty
table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerloom.llm import pieces
from tickerloom.llm.common import arrow_schema, extend_schema, table, without, worker_memo

CAPACITY = 2048
SLACK = 32  # a piece may waste at most 1/SLACK of a bin filled with its like
GROUP = 1024
END_ID = 1
TOKENIZER = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}  # fixed value of the public vocabulary

PIECE = "start long, length long, ids_crc32 long, doc_tokens long"


def cut_lengths(n: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids."""
    cuts, rest = [capacity] * (n // capacity), n % capacity
    while rest:
        k = capacity // rest
        if (capacity // k - rest) * k * slack <= capacity:
            cuts.append(rest)
            break
        cuts.append(capacity // (k + 1))
        rest -= cuts[-1]
    return cuts


def _encoder(path: str):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=pieces.load_ranks(path), special_tokens=SPECIAL)


def _ids(encoder, path: str, part: str) -> np.ndarray:
    """A part's ids; what the fast encoder's pattern cannot go through goes to the tokenizer.

    Its pattern backtracks over a run of white space, and gives up on very long ones.
    """
    try:
        return np.asarray(encoder.encode_to_numpy(part, allowed_special="all"))
    except ValueError:
        whole = path.removesuffix(".tiktoken") + ".json"
        tokenizer = worker_memo(f"tokenizer {whole}", lambda: pieces.load_tokenizer(whole))
        return np.array(tokenizer.encode(part, add_special_tokens=False).ids, np.uint32)


def token_pieces(df: DataFrame, text: str = "text", keep: Iterable[str] | None = None,
                 tokenizer: str = TOKENIZER, end_id: int = END_ID, capacity: int = CAPACITY,
                 with_ids: bool = False) -> DataFrame:
    """One row per piece: ``keep``, start, length, ids_crc32, doc_tokens, ids if asked for.

    The rank file holds the vocabulary of the tokenizer file of the same name, so
    its ids are those of the tokenizer, whose special strings are special here too.
    """
    path = pieces.vocabulary(tokenizer)
    results = ["start", "length", "ids_crc32", "doc_tokens", "ids"]
    keep = [c for c in (without(df, [text, *results]).columns if keep is None else keep)
            if c != text]
    narrow = df.select(*[F.col(f"`{c}`") for c in keep],
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    schema = extend_schema(narrow.drop("__text"), PIECE + (", ids array<int>" if with_ids else ""))
    arrow = arrow_schema(schema)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoder = worker_memo(f"tiktoken {path}", lambda: _encoder(path))
        last = np.array([end_id], np.uint32)
        for batch in batches:
            rows, made, crcs, ids = [], [], [], []
            for row, value in enumerate(batch.column(len(keep)).to_pylist()):
                parts = [_ids(encoder, path, part) for part in pieces.segments(value)]
                doc = np.concatenate([*parts, last]).astype("<u4")
                start = 0
                for length in cut_lengths(len(doc), capacity):
                    piece = doc[start:start + length]
                    rows.append(row)
                    made.append((start, length, len(doc)))
                    crcs.append(zlib.crc32(piece.tobytes()))
                    if with_ids:
                        ids.append(piece.astype(np.int32))
                    start += length
            taken = batch.take(pa.array(rows, pa.int64()))
            start, length, total = (pa.array(x, pa.int64()) for x in zip(*made)) if made \
                else (pa.array([], pa.int64()),) * 3
            columns = [taken.column(i) for i in range(len(keep))]
            columns += [start, length, pa.array(crcs, pa.int64()), total]
            columns += [pa.array(ids, arrow.field("ids").type)] if with_ids else []
            yield pa.RecordBatch.from_arrays(columns, names=arrow.names)

    return narrow.mapInArrow(run, schema)


def _first_fit(capacity: int):
    """Packs one bounded group of left-over pieces, longest first."""
    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "__row"], ascending=[False, True])
        used: list[int] = []
        lowest: dict[int, int] = {}  # no bin before this one has room for a length
        bins, offsets = [], []
        for length in group["length"]:
            at = lowest.get(length, 0)
            while at < len(used) and used[at] + length > capacity:
                at += 1
            lowest[length] = at
            if at == len(used):
                used.append(0)
            bins.append(at)
            offsets.append(used[at])
            used[at] += length
        group["sequence_id"] = (np.int64(1) << 62) + (int(key[0]) << 20) + np.array(bins, np.int64)
        group["offset"] = np.array(offsets, np.int64)
        return group.drop(columns=["__part"])

    return run


def harmonic_pack(lengths: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    The rows are checkpointed first: their row ids, which deal them to groups,
    stay the same when a task is run again. Only the number of rows of each
    class, at most 2 * sqrt(capacity) rows, comes to the driver.
    """
    spark = lengths.sparkSession
    kept = (without(lengths, ["sequence_id", "offset"]).checkpoint()
            .withColumn("__row", F.monotonically_increasing_id())
            .withColumn("__class", F.expr(f"int({capacity} div length)")))
    counts = {r["__class"]: r["count"] for r in kept.groupBy("__class").count().collect()}
    groups = {k: -(-n // group) for k, n in counts.items()}
    deal = spark.createDataFrame(list(groups.items()) or [(1, 1)], "__class int, __groups long")
    kept = (kept.join(F.broadcast(deal), "__class")
            .withColumn("__group", F.col("__row") % F.col("__groups")))
    alike = Window.partitionBy("__class", "__group")
    k = F.col("__class")
    kept = (kept.withColumn("__n", F.count("*").over(alike))
            .withColumn("__place", F.row_number().over(alike.orderBy("__row")) - 1)
            .withColumn("__bin", F.floor(F.col("__place") / k)))
    full = F.col("__place") < F.col("__n") - F.col("__n") % k
    in_bin = Window.partitionBy("__class", "__group", "__bin").orderBy("__place")
    columns = [c for c in kept.columns if not c.startswith("__")]
    filled = kept.where(full).select(
        *columns,
        (k.cast("long") * F.lit(1 << 50) + F.col("__group") * F.lit(1 << 20) + F.col("__bin"))
        .alias("sequence_id"),
        (F.sum("length").over(in_bin) - F.col("length")).alias("offset"))
    parts = max(groups.values(), default=1)
    rest = (kept.where(~full).select(*columns, "__row")
            .withColumn("__part", F.col("__row") % F.lit(parts)))
    schema = extend_schema(rest.drop("__part"), "sequence_id long, offset long")
    packed = rest.groupBy("__part").applyInPandas(_first_fit(capacity), schema)
    return filled.unionByName(packed.drop("__row"))


def pack(df: DataFrame, text: str = "text", keep: Iterable[str] | None = None,
         with_ids: bool = False, capacity: int = CAPACITY) -> DataFrame:
    """Packs the token ids of all texts; one row per piece."""
    return harmonic_pack(token_pieces(df, text, keep, capacity=capacity, with_ids=with_ids),
                         capacity)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), keep=["doc_id"])


QUERIES = {"op3_packing": op3_packing}
ORACLES: dict[str, str] = {}
