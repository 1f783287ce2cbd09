"""Exact duplicates by polynomial fingerprints that compose from chunks.

A text, white space runs replaced by one blank, is a polynomial over its UTF-8
bytes, modulo two primes. The fingerprint of two pieces together is the first
one's times the base to the length of the second, plus the second one's, so chunks
are hashed on their own and their fingerprints combined by length-shifted
arithmetic. An ordinary text is hashed chunk by chunk where its row lies; the
chunks of a huge one are dealt out over the tasks and folded afterwards.

Equal length and fingerprint only make a text a candidate. The candidates of a
fingerprint are compared with the first of them, chunk by chunk, in an equi-join
on fingerprint, salt and chunk: a group of any size is dealt over as many salts
as it needs, and only one chunk of the first text is held at a time. What differs
from the first text is compared anew among itself, until nothing differs, so the
result does not rest on the fingerprint.

Defined results: a null text counts as empty; repeated rows come back repeated and
count each; of equal texts the row with the smallest id stays, one of them if
several have it, and a null id comes after all others; an empty table gives no
rows; input columns named like result columns give way.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm.common import BROADCAST_IDS, arrow_ready, table, without, worker_memo

CHUNK = 1 << 16  # bytes that are hashed and compared at a time
HUGE = 1 << 22  # bytes from which the chunks of a text are dealt out
SALT_ROWS = 1024  # candidates of a fingerprint that meet one copy of the first
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1664525013)
RESULTS = ["keep_id", "group_size", "kept"]
_KEY = ["__bytes", "__print"]


def normal(text: Column) -> Column:
    """White space runs as one blank; single blanks need no replacement."""
    return F.regexp_replace(F.coalesce(text, F.lit("")),
                            r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def chunks(body: Column, size: int) -> Column:
    """A binary column cut into pieces of ``size`` bytes; none for an empty one."""
    count = F.ceil(F.octet_length(body) / F.lit(size))
    return F.when(count > 0, F.transform(
        F.sequence(F.lit(0).cast("long"), count - 1),
        lambda i: F.substring(body, (i * size + 1).cast("int"), F.lit(size))
    )).otherwise(F.array().cast("array<binary>"))


def powers(size: int, primes=PRIMES) -> list[np.ndarray]:
    """Falling powers of each base: the weights of the last ``size`` bytes."""
    out = []
    for base, prime in zip(BASES, primes):
        row = np.ones(size, np.int64)
        for i in range(1, size):
            row[i] = row[i - 1] * base % prime
        out.append(np.ascontiguousarray(row[::-1]))
    return out


def chunk_element(piece: bytes, weights: list[np.ndarray], primes=PRIMES) -> list[int]:
    """(hash, shift) of a chunk for each prime; a chunk has at most 2**24 bytes."""
    values = np.frombuffer(piece, np.uint8).astype(np.int64)
    out = []
    for base, prime, weight in zip(BASES, primes, weights):
        out += [int(values @ weight[len(weight) - len(values):]) % prime,
                pow(base, len(values), prime)]
    return out


def combined(elements: Iterable[list[int]], primes=PRIMES) -> tuple[int, int]:
    """The hashes of pieces in order, by length-shifted arithmetic."""
    h = [0, 0]
    for h1, s1, h2, s2 in elements:
        h = [(h[0] * s1 + h1) % primes[0], (h[1] * s2 + h2) % primes[1]]
    return h[0], h[1]


def fingerprint(size: int, primes=PRIMES):
    """Column function: both hashes of a whole text in one long."""
    @F.arrow_udf("long")
    def run(bodies):
        import pyarrow as pa

        weights = worker_memo(f"powers {size} {primes}", lambda: powers(size, primes))
        out = []
        for body in bodies:
            view = memoryview(body.as_buffer())
            h1, h2 = combined((chunk_element(view[at:at + size], weights, primes)
                               for at in range(0, len(view), size)), primes)
            out.append(h1 << 31 | h2)
        return pa.array(out, pa.int64())

    return run


def chunk_fingerprint(size: int, primes=PRIMES):
    """Column function: (hash, shift) of a chunk for each prime."""
    @F.arrow_udf("array<long>")
    def run(pieces):
        import pyarrow as pa

        weights = worker_memo(f"powers {size} {primes}", lambda: powers(size, primes))
        return pa.array([chunk_element(memoryview(p.as_buffer()), weights, primes)
                         for p in pieces], pa.list_(pa.int64()))

    return run


def folded(elements: Column, primes=PRIMES) -> Column:
    """``combined`` as a column expression over an array of (chunk, element), in one long."""
    zero = F.struct(F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"))
    return F.aggregate(F.sort_array(elements), zero, lambda a, e: F.struct(
        ((a["h1"] * e["element"][1] + e["element"][0]) % primes[0]).alias("h1"),
        ((a["h2"] * e["element"][3] + e["element"][2]) % primes[1]).alias("h2"),
    ), lambda a: F.shiftleft(a["h1"], 31).bitwiseOR(a["h2"]))


def _few(df: DataFrame) -> DataFrame:
    """``df``, checkpointed, broadcast if it has few enough rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def differing(pieces: DataFrame, firsts: DataFrame) -> DataFrame:
    """Rows (``__row``) whose chunks differ from those of the first row of their key.

    ``pieces`` are (row, key, chunk, body), ``firsts`` (key, first, n).
    """
    placed = pieces.join(firsts, _KEY).withColumn(
        "__salts", F.ceil(F.col("__n") / F.lit(SALT_ROWS)))
    by = [*_KEY, "__salt", "__chunk"]
    heads = (placed.where("__row = __first")
             .withColumn("__salt", F.explode(F.expr("sequence(0L, __salts - 1)")))
             .select(*by, F.col("__body").alias("__head")))
    members = placed.where("__row <> __first").withColumn(
        "__salt", F.expr("pmod(xxhash64(__row), __salts)")).select("__row", *by, "__body")
    return (members.join(heads, by).where("__body <> __head")
            .select("__row").distinct())


def resolved(df: DataFrame, id: str, text: str, keep: list[str], measures: list[Column],
             chunk: int = CHUNK, huge: int = HUGE,
             primes: tuple[int, int] = PRIMES) -> DataFrame:
    """Columns k0.. of ``keep``, m0.. of ``measures``, ``__keep``, ``__size``, ``__kept``."""
    arrow_ready(df.sparkSession)
    docs = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
                     F.col(f"`{id}`").alias("__id"), normal(F.col(f"`{text}`")).alias("normal"))
    docs = docs.withColumns({f"m{i}": c for i, c in enumerate(measures)})
    docs = docs.withColumn("__body", F.col("normal").cast("binary")).drop("normal").withColumn(
        "__bytes", F.octet_length("__body").cast("long"))
    narrow = [c for c in docs.columns if c != "__body"]

    marked = docs.where(F.col("__bytes") <= huge).withColumn(
        "__print", fingerprint(chunk, primes)(F.col("__body")))
    rows = docs.where(F.col("__bytes") > huge).withColumn(
        "__row", -1 - F.monotonically_increasing_id())
    long_pieces = rows.select("*", F.posexplode(chunks(F.col("__body"), chunk))
                              .alias("__chunk", "__piece")).drop("__body").checkpoint()
    dealt = long_pieces.select("__row", "__chunk", "__piece").repartition("__row", "__chunk")
    long_prints = (
        dealt.select("__row", F.struct("__chunk", chunk_fingerprint(chunk, primes)(
            F.col("__piece")).alias("element")).alias("e"))
        .groupBy("__row").agg(folded(F.collect_list("e"), primes).alias("__print")))
    long_rows = long_pieces.where("__chunk = 0").select(*narrow, "__row").join(
        long_prints, "__row")
    every = (marked.select(*narrow, "__print")
             .withColumn("__row", F.monotonically_increasing_id())
             .unionByName(long_rows).checkpoint())

    groups = _few(every.groupBy(*_KEY).agg(F.count("*").alias("__n")).where("__n > 1")
                  .select(*_KEY).checkpoint())
    alone = every.join(groups, _KEY, "left_anti")
    short = (marked.join(groups, _KEY, "left_semi")
             .withColumn("__row", F.monotonically_increasing_id()).checkpoint())
    members = (short.select(*narrow, "__row", "__print")
               .unionByName(every.where("__row < 0").join(groups, _KEY, "left_semi")))
    pieces = (short.select("__row", *_KEY, F.posexplode(chunks(F.col("__body"), chunk))
                           .alias("__chunk", "__body"))
              .unionByName(long_pieces.select("__row", "__chunk", F.col("__piece").alias("__body"))
                           .join(every.where("__row < 0").select("__row", *_KEY), "__row")))

    classes = []
    while True:
        firsts = _few(members.groupBy(*_KEY).agg(
            F.min(F.struct(F.isnull("__id").alias("null"), "__id", "__row")).alias("first"),
            F.count("*").alias("__n")).select(
            *_KEY, F.col("first.__row").alias("__first"), F.col("first.__id").alias("__keep"),
            "__n").checkpoint())
        other = differing(pieces, firsts).checkpoint()
        placed = members.join(firsts.drop("__n"), _KEY)
        if not other.head(1):
            classes.append(placed)
            break
        classes.append(placed.join(other, "__row", "left_anti"))
        members = members.join(other, "__row", "left_semi").checkpoint()
        pieces = pieces.join(other, "__row", "left_semi")

    found = classes[0]
    for one in classes[1:]:
        found = found.unionByName(one)
    sizes = found.groupBy("__first").agg(F.count("*").alias("__size"))
    results = [c for c in narrow if not c.startswith("__")] + ["__keep", "__size", "__kept"]
    found = found.join(sizes, "__first").withColumn("__kept", F.expr("__row = __first"))
    alone = alone.withColumns({"__keep": F.col("__id"), "__size": F.lit(1).cast("long"),
                               "__kept": F.lit(True)})
    return found.select(*results).unionByName(alone.select(*results))


def exact_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text",
                     keep: Iterable[str] | None = None,
                     measures: Mapping[str, Column] | None = None, **sizes) -> DataFrame:
    """``keep`` (all columns but the text), ``measures``, and RESULTS for each row.

    ``measures`` are columns over the normalised text, which they see as ``normal``.
    ``sizes`` are ``chunk`` and ``huge``, which bounds the bytes one task hashes alone,
    and the ``primes``.
    """
    measures = dict(measures or {})
    keep = without(df, [text, *RESULTS, *measures]).columns if keep is None else list(keep)
    return resolved(df, id, text, keep, list(measures.values()), **sizes).select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        *[F.col(f"m{i}").alias(c) for i, c in enumerate(measures)],
        F.col("__keep").alias("keep_id"), F.col("__size").alias("group_size"),
        F.col("__kept").alias("kept"))


def kept_documents(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, one of each group of equal texts."""
    return resolved(df, id, text, df.columns, []).where("__kept").select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(df.columns)])


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), keep=["doc_id"],
                            measures={"text_sha256": F.sha2("normal", 256)})


QUERIES = {"op12_exact_dedup": op12_exact_dedup}
ORACLES = {"op12_exact_dedup": r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
  FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept,
       sha256(t) AS text_sha256
FROM texts"""}
