"""Token ids from a corpus vocabulary, fixed-size chunks, padded batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tickerloom.operators.numbering import global_row_number

# --- fixed values -----------------------------------------------------------
MAX_LENGTH = 1024
BATCH_SIZE = 4
IGNORED_LABEL = -100
UNKNOWN_ID = -1
# ----------------------------------------------------------------------------

# Chat markers are single tokens, then words, then single symbols.
TOKEN = r"(<\|im_start\|>|<\|im_end\|>|[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\n\r\f\x0b])"

# The most frequent tokens are looked up by broadcast. Their number and length
# are fixed, so the broadcast stays small whatever the corpus is.
FREQUENT = 1024
FREQUENT_CHARS = 64

# Up to this many bytes, counting ROW_BYTES on top of each token, a vocabulary
# is broadcast whole.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 64

# Of a larger vocabulary, this many of its commonest tokens are looked up in place.
LOOKED_UP = 1 << 18


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(1))


def token_rows(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    return df.select(*keys, F.posexplode(tokens_of(F.col(text))).alias("pos", "token"))


def vocabulary(tokens: DataFrame) -> DataFrame:
    """(token, token_id, n): ids from 0 by falling count, ties by token."""
    counts = tokens.groupBy("token").agg(F.count("*").alias("n"))
    ranked = global_row_number(counts, [F.desc("n"), F.asc("token")], "__rank")
    return ranked.select("token", (F.col("__rank") - 1).cast("int").alias("token_id"), "n")


def with_ids(tokens: DataFrame, vocab: DataFrame, unknown_id: int = UNKNOWN_ID) -> DataFrame:
    """Token rows with their ids; a token outside the vocabulary gets ``unknown_id``.

    A vocabulary whose measured size is small is broadcast whole. A larger one
    is split: common tokens make up most of any text and would be hot join
    keys, so they are matched by broadcast, and only the rare rest is shuffled
    on the token.
    """
    vocab = vocab.select("token", "token_id")
    if _measured(vocab) <= BROADCAST_BYTES:
        return tokens.join(F.broadcast(vocab), "token", "left").fillna(unknown_id, ["token_id"])
    common = (F.col("token_id") < FREQUENT) & (F.length("token") <= FREQUENT_CHARS)
    looked_up = tokens.join(F.broadcast(vocab.where(common)), "token", "left")
    hits = looked_up.where("token_id is not null")
    misses = looked_up.where("token_id is null").drop("token_id").join(
        vocab.where(~common), "token", "left").fillna(unknown_id, ["token_id"])
    return hits.unionByName(misses)


def _measured(vocab: DataFrame) -> int:
    size = vocab.agg(F.sum(F.octet_length("token") + ROW_BYTES).alias("bytes")).first()
    return size["bytes"] or 0


def encode_texts(df: DataFrame, vocab: DataFrame, keys: Sequence[str], text: str,
                 max_length: int = MAX_LENGTH) -> DataFrame:
    """(keys, chunk_no, input_ids) of whole texts; the same rows as ``encode_chunks``.

    A vocabulary measured as small goes to every executor, and each slice of tokens
    is looked up where it lies: no token is shuffled. Of a larger one a fixed number of
    common tokens is looked up so; only the rare rest of a slice becomes rows that meet
    the vocabulary in a join, and comes back as one row per slice. Texts that are null
    or without tokens have no row.
    """
    vocab = vocab.select("token", "token_id")
    slices = chunk_ids(df.select(*keys, tokens_of(F.col(text)).alias("__tokens")),
                       "__tokens", max_length)
    whole = _measured(vocab) <= BROADCAST_BYTES
    common = (F.col("token_id") < LOOKED_UP) & (F.length("token") <= FREQUENT_CHARS)
    sent = vocab if whole else vocab.where(common)
    known = df.sparkSession.sparkContext.broadcast(sent.toArrow())
    schema = StructType([
        *slices.drop("__tokens").schema, StructField("input_ids", ArrayType(IntegerType())),
        StructField("__places", ArrayType(IntegerType())),
        StructField("__rest", ArrayType(StringType()))])
    looked = slices.mapInArrow(_lookup(known), schema)
    ids = F.col("input_ids")
    if whole:
        return looked.select(*keys, "chunk_no", F.transform(
            ids, lambda i: F.coalesce(i, F.lit(UNKNOWN_ID))).alias("input_ids"))
    group = [*keys, "chunk_no"]
    rare = looked.select(*group, F.explode(F.arrays_zip("__places", "__rest")).alias("r")).select(
        *group, F.col("r.__places").alias("place"), F.col("r.__rest").alias("token"))
    found = rare.join(vocab.where(~common), "token").groupBy(*group).agg(
        F.map_from_entries(F.collect_list(F.struct("place", "token_id"))).alias("__found"))
    filled = F.transform(ids, lambda i, place: F.coalesce(
        i, F.element_at("__found", place), F.lit(UNKNOWN_ID)))
    return looked.join(found, group, "left").select(*group, filled.alias("input_ids"))


def _lookup(known):
    """Task: the last column's tokens to ids, one hash lookup per distinct token of a batch.

    What is not known gets a null, its place in the slice and its token are listed.
    """
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        words = known.value["token"].combine_chunks()
        ids = known.value["token_id"].combine_chunks().cast(pa.int32())
        for batch in batches:
            *others, slices = batch.columns
            flat = slices.flatten()
            found = flat.dictionary_encode()
            of_word = ids.take(pc.index_in(found.dictionary.cast(words.type), value_set=words))
            encoded = of_word.take(found.indices)
            starts = slices.offsets.to_numpy() - slices.offsets[0].as_py()
            at = np.flatnonzero(encoded.is_null().to_numpy(zero_copy_only=False))
            ends = pa.array(np.searchsorted(at, starts).astype("int32"))
            row = np.searchsorted(starts, at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*others, pa.ListArray.from_arrays(pa.array(starts.astype("int32")), encoded),
                 pa.ListArray.from_arrays(ends, pa.array((at - starts[row]).astype("int32"))),
                 pa.ListArray.from_arrays(ends, flat.take(pa.array(at)))],
                names=[*batch.schema.names[:-1], "input_ids", "__places", "__rest"])

    return run


def encode_chunks(tokens: DataFrame, vocab: DataFrame, keys: Sequence[str],
                  max_length: int = MAX_LENGTH) -> DataFrame:
    """(keys, chunk_no, input_ids): an example's ids in slices of ``max_length``.

    Ids are gathered per slice, never per example, so no group holds more than
    ``max_length`` rows. The last slice is as short as it comes; an example
    without tokens has none.
    """
    chunk = F.floor(F.col("pos") / max_length).cast("int").alias("chunk_no")
    gathered = with_ids(tokens, vocab).groupBy(*keys, chunk).agg(
        F.array_sort(F.collect_list(F.struct("pos", "token_id"))).alias("__slice"))
    return gathered.select(*keys, "chunk_no", F.col("__slice.token_id").alias("input_ids"))


def chunk_ids(df: DataFrame, ids: str = "input_ids",
              max_length: int = MAX_LENGTH) -> DataFrame:
    """The same slicing for rows that already hold an id array."""
    others = [c for c in df.columns if c != ids]
    size = F.size(ids)
    starts = F.when(size > 0, F.sequence(F.lit(0), size - 1, F.lit(max_length)))
    return (
        df.withColumn("__start", F.explode(starts))
        .select(*others, (F.col("__start") / max_length).cast("int").alias("chunk_no"),
                F.slice(ids, F.col("__start") + 1, F.lit(max_length)).alias(ids))
    )


def attention_mask(ids: Column) -> Column:
    return F.array_repeat(F.lit(1), F.size(ids))


def chunk_sizes(df: DataFrame, keys: Sequence[str], text: str,
                max_length: int = MAX_LENGTH) -> DataFrame:
    """(keys, chunk_no, n_ids) of the slices that texts give, without encoding them."""
    n = F.col("__n")
    counted = df.select(*keys, F.size(tokens_of(F.col(text))).alias("__n"))
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(max_length)))
    return counted.select(*keys, "__n", F.posexplode(starts).alias("chunk_no", "__at")).select(
        *keys, "chunk_no", F.least(F.lit(max_length), n - F.col("__at")).alias("n_ids"))


def batch_numbers(narrow: DataFrame, keys: Sequence[str],
                  size: int = BATCH_SIZE) -> DataFrame:
    """(keys, n_ids, batch_id, batch_len) for chunks (keys, n_ids) in key order."""
    numbered = global_row_number(narrow, [F.asc(k) for k in keys], "__row")
    batch = F.floor((F.col("__row") - 1) / size).alias("batch_id")
    in_batch = Window.partitionBy("batch_id")
    return numbered.select(*keys, "n_ids", batch).withColumn(
        "batch_len", F.max("n_ids").over(in_batch))


def pad_batches(chunks: DataFrame, keys: Sequence[str], pad_id: int = 0,
                size: int = BATCH_SIZE, sizes: DataFrame | None = None) -> DataFrame:
    """Groups of ``size`` chunks padded to the longest of the group.

    ``sizes`` (keys, n_ids) spares a second encoding if the chunks' lengths are
    known otherwise, as from ``chunk_sizes``.
    """
    if sizes is None:
        sizes = chunks.select(*keys, F.size("input_ids").alias("n_ids"))
    joined = chunks.join(batch_numbers(sizes, keys, size), list(keys))
    missing = F.col("batch_len") - F.col("n_ids")

    def padded(values: Column, filler: int) -> Column:
        return F.concat(values, F.array_repeat(F.lit(filler), missing))

    ids = F.col("input_ids")
    return joined.select(
        *keys, "batch_id", "n_ids", "batch_len",
        padded(ids, pad_id).alias("input_ids"),
        padded(attention_mask(ids), 0).alias("attention_mask"),
        padded(ids, IGNORED_LABEL).alias("labels"))
