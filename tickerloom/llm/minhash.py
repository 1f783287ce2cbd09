"""Near-duplicate documents by tensored MinHash banding, confirmed on full sets.

Two small collections of half keys, A (two minhashes each) and B (one each), are
computed per distinct shingle set. A table key is a pair (A_i, B_j), so 12 + 8
half keys (32 minhashes) give 96 tables. Sets meet where a half key A_i is equal
and become candidates if some B_j is equal too. A pair with similarity 0.8 is
missed with a probability below 1e-5.

A bucket of equal A_i is split into blocks of bounded size by a hash of the id.
First every set meets a few centres of its blocks; confirmed links are joined to
components. Then, only in buckets that still hold several components, all pairs
of blocks are compared by sketches inside tasks, and pairs of different
components that may reach the threshold are confirmed on their full sets. So no
group is gathered in one task and pairs within a component are never listed.

Defined results: a null text or one without words has no shingles and is linked
with nothing; equal sets are one class, whatever their number; a row with a null
id is kept, linked with nothing, and has a null component; rows that share an id
are one document; columns named like result columns give way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import shingles as sh
from tickerloom.llm.common import arrow_ready, map_texts, rows_of, table, worker_memo
from tickerloom.llm.components import components
from tickerloom.llm.pieces import grouped

A_KEYS, A_WIDTH, B_KEYS = 12, 2, 8
SKETCH_BITS = 9
BLOCK = 256  # sets in a block of a bucket
BLOCK_SHINGLES = 2_000_000
FEATURES = "n_shingles long, set_hash binary, a array<long>, halves binary, sketch binary"


def _multipliers() -> np.ndarray:
    count = A_KEYS * A_WIDTH + B_KEYS
    return sh.scramble(np.arange(1, count + 1, dtype=np.uint64) * sh._ODD) | np.uint64(1)


def sketch_of(values: np.ndarray) -> bytes:
    """One byte for each of 512 value ranges: 0 for none, else of the smallest value there."""
    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    if len(values):
        cells, first = np.unique(values >> np.uint64(64 - SKETCH_BITS), return_index=True)
        out[cells.astype(np.int64)] = 1 + values[first] % np.uint64(255)
    return out.tobytes()


def features(df: DataFrame, id: str, text: str, k: int) -> DataFrame:
    """Id, set size, set hash, half keys and sketch of every text's shingle set."""
    def rows():
        hashes = worker_memo("word hashes", sh.WordHashes)
        multipliers = _multipliers()

        def work(texts: list[str]) -> dict:
            out: dict[str, list] = {n: [] for n in ("n_shingles", "set_hash", "a", "halves", "sketch")}
            for some in grouped(texts, len):
                sets = [np.unique(sh.shingle_hashes(hashes(sh.words_of(t)), k)) for t in some]
                full = [s for s in sets if len(s)]
                low = np.zeros((len(multipliers), len(full)), np.uint64)
                if full:
                    values = np.concatenate(full)
                    starts = np.cumsum([0, *[len(s) for s in full[:-1]]])
                    for row, by in enumerate(multipliers):
                        mixed = values * by
                        mixed ^= mixed >> np.uint64(32)
                        low[row] = np.minimum.reduceat(mixed, starts)
                wide = A_KEYS * A_WIDTH
                a = sh.scramble(low[0:wide:2] * sh._ODD + low[1:wide:2]).T.astype(np.int64)
                b = sh.scramble(low[wide:]).T.astype(np.int64)
                halves = np.hstack([a, b]).astype(np.int32)  # the low 32 bits of each
                at = iter(range(len(full)))
                for s in sets:
                    i = next(at) if len(s) else None
                    out["n_shingles"].append(len(s))
                    out["set_hash"].append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    out["a"].append([] if i is None else a[i].tolist())
                    out["halves"].append(b"" if i is None else halves[i].tobytes())
                    out["sketch"].append(sketch_of(s))
            return out

        return work

    return map_texts(df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")),
                     "text", FEATURES, rows, ["id"])


def _may_link(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray,
              threshold: float) -> np.ndarray:
    """For rows of sketches and set sizes, which pairs (x row, y row) may have the similarity.

    Sizes that differ by more than the threshold allows rule a pair out. A cell
    counts if either side has a value; it shows whether the smallest element of
    the union there is shared. The cells are drawn from the union without
    replacement, which shrinks their deviation; five deviations and one cell
    below the threshold still pass, so true links do not get lost here.
    """
    out = np.empty((len(x), len(y)), bool)
    filled = y > 0
    for i, one in enumerate(x):
        cells = (filled | (one > 0)).sum(axis=1)
        same = ((y == one) & filled).sum(axis=1)
        union = np.maximum((nx[i] + ny) / (1 + threshold), cells + 1)
        slack = 5 * np.sqrt(threshold * (1 - threshold) / np.maximum(cells, 1)
                            * (union - cells) / (union - 1))
        sizes = np.minimum(nx[i], ny) >= threshold * np.maximum(nx[i], ny) - 1e-9
        out[i] = sizes & (same + 1 >= (threshold - slack) * cells)
    return out


def _block_pairs(exhaustive: bool, threshold: float):
    """Streams blocks sorted by bucket and gives candidate pairs (a, b) of ids."""
    def pairs_of(rows: dict, first: np.ndarray, second: np.ndarray):
        """Pairs of rows of ``first`` and ``second`` that pass all tests."""
        ok = _may_link(rows["sketch"][first], rows["n_shingles"][first],
                       rows["sketch"][second], rows["n_shingles"][second], threshold)
        for n, i in enumerate(first):
            js = second[ok[n] & (rows["comp"][second] != rows["comp"][i])]
            tables = (rows["b"][js] == rows["b"][i]).any(axis=1)
            if exhaustive:  # only where the pair meets first
                tables &= (rows["a"][js] == rows["a"][i]).argmax(axis=1) == rows["i"][i]
            for j in js[tables]:
                yield (i, j) if rows["id"][i] < rows["id"][j] else (j, i)

    def group_pairs(rows: dict):
        if exhaustive:
            side = rows["side"]
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if len(right):
                yield from pairs_of(rows, left, right)
            else:
                for n, i in enumerate(left):
                    yield from pairs_of(rows, np.array([i]), left[n + 1:])
        else:  # two centres: the smallest id, and one that differs from table to table
            n = len(rows["id"])
            mixed = sh.scramble(rows["id"].astype(np.uint64) * sh._ODD
                                + rows["i"].astype(np.uint64))
            for centre in {int(rows["id"].argmin()), int(mixed.argmin())}:
                yield from pairs_of(rows, np.array([centre]), np.arange(n))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        key, held = None, []

        def flush():
            rows = {name: np.array([h[name] for h in held])
                    for name in ("id", "comp", "i", "side", "n_shingles")}
            halves = np.frombuffer(b"".join(h["halves"] for h in held),
                                   np.int32).reshape(len(held), -1)
            rows["a"], rows["b"] = halves[:, :A_KEYS], halves[:, A_KEYS:]
            rows["sketch"] = np.frombuffer(b"".join(h["sketch"] for h in held),
                                           np.uint8).reshape(len(held), -1)
            pairs = list(group_pairs(rows))
            return sorted({(rows["id"][i], rows["id"][j]) for i, j in pairs})

        found: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != key:
                    if len(held) > 1:
                        found += flush()
                    key, held = row["bucket"], []
                held.append(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(p[i]) for p in found], pa.int64()) for i in (0, 1)],
                names=["a", "b"])
            found = []
        if len(held) > 1:
            found = flush()
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(p[i]) for p in found], pa.int64()) for i in (0, 1)],
                names=["a", "b"])

    return run


def candidate_pairs(sets: DataFrame, exhaustive: bool, threshold: float) -> DataFrame:
    """Distinct candidate pairs of ids among ``sets`` (features and ``comp``).

    Pairs with the centres of blocks or, if ``exhaustive``, all in two blocks.
    """
    places = sets.select("id", "comp", "n_shingles", F.posexplode("a").alias("i", "half"))
    buckets = places.groupBy("i", "half").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("total"),
        F.min("comp").alias("low"), F.max("comp").alias("high")
    ).where("n > 1 and low <> high").select(
        "i", "half", F.expr(f"int(greatest(ceil(n / {BLOCK}), ceil(total / {BLOCK_SHINGLES})))")
        .alias("blocks"))
    placed = (places.drop("n_shingles").join(buckets, ["i", "half"])
              .withColumn("block", F.expr("int(pmod(xxhash64(id, half), blocks))")))
    if exhaustive:  # a row goes to every pair of blocks that its block is in
        placed = (placed.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
                  .withColumn("side", F.expr("int(block > other)"))
                  .withColumn("bucket", F.xxhash64("i", "half", F.least("block", "other"),
                                                   F.greatest("block", "other"))))
    else:
        placed = (placed.withColumn("side", F.lit(0))
                  .withColumn("bucket", F.xxhash64("i", "half", "block")))
    full = placed.select("bucket", "side", "i", "id", "comp").join(
        sets.select("id", "n_shingles", "halves", "sketch"), "id")
    return (full.repartition("bucket").sortWithinPartitions("bucket", "id")
            .mapInArrow(_block_pairs(exhaustive, threshold), "a long, b long").distinct())


def shingle_sets(df: DataFrame, id: str, text: str, k: int) -> DataFrame:
    """Id and the sorted shingle hashes of its text, packed."""
    def rows():
        hashes = worker_memo("word hashes", sh.WordHashes)
        return lambda texts: {"packed": [
            np.unique(sh.shingle_hashes(hashes(sh.words_of(t)), k)).tobytes() for t in texts]}

    return map_texts(df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")),
                     "text", "packed binary", rows, ["id"])


def confirm(pairs: DataFrame, texts: DataFrame, id: str, text: str, k: int,
            threshold: float) -> DataFrame:
    """Those ``pairs`` whose full shingle sets reach the threshold.

    Pairs are grouped by their more popular side and by a salt, so its set is
    sent once for at most about a block of partners.
    """
    percent = round(100 * threshold)
    ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    fame = ends.groupBy("id").agg(F.count("*").alias("fame")).checkpoint()
    sets = (shingle_sets(rows_of(texts, fame.select(F.col("id").alias(id)), id), id, text, k)
            .groupBy("id").agg(F.min("packed").alias("packed")).checkpoint())
    turned = (pairs.join(fame.select(F.col("id").alias("a"), F.col("fame").alias("fa")), "a")
              .join(fame.select(F.col("id").alias("b"), F.col("fame").alias("fb")), "b")
              .select(F.expr("if(fa > fb, a, b)").alias("hub"),
                      F.expr("if(fa > fb, b, a)").alias("id"),
                      F.expr("greatest(fa, fb)").alias("fame"))
              .withColumn("salt", F.expr(f"pmod(xxhash64(id), ceil(fame / {BLOCK}))"))
              .checkpoint())
    partners = turned.join(sets, "id").select(
        "hub", "salt", F.lit(1).alias("kind"), "id", "packed")
    hubs = (turned.select("hub", "salt").distinct()
            .join(sets.withColumnRenamed("id", "hub"), "hub")
            .select("hub", "salt", F.lit(0).alias("kind"), F.col("hub").alias("id"), "packed"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hub = None
        for batch in batches:
            a, b = [], []
            for row in batch.to_pylist():
                values = np.frombuffer(row["packed"], np.uint64)
                if row["kind"] == 0:
                    hub = values
                    continue
                both = np.concatenate([hub, values])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                if 100 * shared >= percent * (len(both) - shared):
                    a.append(row["hub"])
                    b.append(row["id"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return (partners.unionByName(hubs).repartition("hub", "salt")
            .sortWithinPartitions("hub", "salt", "kind", "id")
            .mapInArrow(run, "a long, b long"))


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", k: int = 5,
                    threshold: float = 0.8) -> DataFrame:
    """Id, ``n_shingles``, ``component_id`` and ``kept`` for every row.

    Shingles have ``k`` words; documents are linked from the similarity
    ``threshold`` on; one document of each component is kept.
    """
    arrow_ready(df.sparkSession)
    found = features(df, id, text, k).checkpoint()
    full = found.where("n_shingles > 0 and id is not null")
    classes = full.groupBy("set_hash").agg(F.min("id").alias("rep"))
    sets = (full.join(classes, (full.set_hash == classes.set_hash) & (full.id == classes.rep))
            .select("id", "n_shingles", "a", "halves", "sketch").dropDuplicates(["id"])
            .withColumn("comp", F.col("id")).checkpoint())
    texts = df.where(F.col(id).isNotNull())
    links, labels = None, None
    for exhaustive in (False, True):
        if labels is not None:
            sets = (sets.drop("comp").join(labels, "id", "left")
                    .withColumn("comp", F.coalesce("component", "id")).drop("component"))
        more = confirm(candidate_pairs(sets, exhaustive, threshold).checkpoint(), texts, id, text, k,
                       threshold).checkpoint()
        links = more if links is None else links.unionByName(more)
        labels = components(links)
    reps = classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        "set_hash", F.coalesce("component", "rep").alias("component"))
    component = F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("component"))
    return (found.join(reps, "set_hash", "left")
            .select(F.col("id").alias(id), "n_shingles",
                    F.when(F.col("id").isNotNull(), component).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id) == F.col("component_id"), F.lit(True))))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=4, threshold=0.8)


QUERIES = {"op9_minhash": op9_minhash}
ORACLES: dict[str, str] = {}
