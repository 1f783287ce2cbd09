"""Exact top-k inner products through a pivot-distance index.

Every vector x gets one more component, sqrt(R^2 - |x|^2) with R the largest
norm, and a query gets 0 there. Then |q - x|^2 = |q|^2 + R^2 - 2 q.x, so the
largest inner products are the smallest distances and the triangle inequality
holds. Vectors are keyed by their nearest pivot and the distance to it; an entry
of the index is a pivot's annulus, split by a hash into blocks of bounded size.

A query first searches the blocks of its home annulus, which gives it a bound
on its k-th distance. It is then sent only to blocks whose annulus the bound
reaches, and in a block its annuli are expanded outwards from the query's own
distance until the triangle inequality shows that nothing nearer can follow.
Products are integers, so the scores are exact; bounds on distances have slack
for rounding.

Defined results: vectors that are null, empty, or hold null or non-finite components
take no part, nor do rows with a null id; vectors are scored against those of their
own length; an id that occurs twice takes part once, with its smallest vector; ties
go to the smaller id; a component or a score that no long holds counts as the long
nearest to it; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerloom.llm.common import arrow_ready, arrow_schema, table

PIVOTS = 48  # at most; taken from a sample of the vectors
SAMPLE = 4096  # vectors that pivots and annulus edges are fitted on
RINGS = 8  # annuli of a pivot
BLOCK = 2048  # vectors in a block, queries in a part
STEP = 128  # vectors searched at once in a block
_SLACK = 1e-6  # relative, on squared distances
_LOWEST = -(1 << 63)  # below any score
_MOST = (1 << 63) - 1


class Index:
    """Pivots and annulus edges, fitted on a bounded sample; used to place any vector."""

    def __init__(self, sample: np.ndarray, radius2: float):
        self.radius2 = radius2
        lifted = self.lift(sample)
        chosen = [0] if len(lifted) else []
        near = np.full(len(lifted), np.inf)
        while chosen and len(chosen) < min(PIVOTS, len(lifted)):
            near = np.minimum(near, ((lifted - lifted[chosen[-1]]) ** 2).sum(1))
            if near.max() <= 0:
                break
            chosen.append(int(near.argmax()))
        self.pivots = lifted[chosen]
        self.edges = np.zeros((len(chosen), RINGS - 1))
        if chosen:
            pivot, distance = self.nearest(lifted)
            for p in range(len(chosen)):
                own = distance[pivot == p]
                self.edges[p] = np.quantile(own if len(own) else [0.0],
                                            np.arange(1, RINGS) / RINGS)

    def lift(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(float)
        rest = np.sqrt(np.maximum(self.radius2 - (x ** 2).sum(1), 0))
        return np.column_stack([x, rest])

    def query(self, q: np.ndarray) -> np.ndarray:
        return np.column_stack([q.astype(float), np.zeros(len(q))])

    def to_pivots(self, points: np.ndarray) -> np.ndarray:
        p = self.pivots
        square = (points ** 2).sum(1)[:, None] + (p ** 2).sum(1) - 2 * points @ p.T
        return np.sqrt(np.maximum(square, 0))

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distances = self.to_pivots(points)
        pivot = distances.argmin(1)
        return pivot, distances[np.arange(len(points)), pivot]

    def ring(self, pivot: np.ndarray, distance: np.ndarray) -> np.ndarray:
        return (distance[:, None] >= self.edges[pivot]).sum(1)


def _vectors(column) -> np.ndarray:
    rows = column.to_pylist()
    return np.array(rows, np.int64).reshape(len(rows), -1)


def _batch(arrow, **columns):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in arrow], names=arrow.names)


PLACED = "id long, v array<long>, cell int, distance double"


def _place(index: Index):
    """Each vector's cell (pivot and annulus) and distance to the pivot."""
    arrow = arrow_schema(PLACED)

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            if batch.num_rows:
                pivot, distance = index.nearest(index.lift(_vectors(batch.column(1))))
                yield _batch(arrow, id=batch.column(0).to_pylist(),
                             v=batch.column(1).to_pylist(),
                             cell=pivot * RINGS + index.ring(pivot, distance), distance=distance)

    return run


SENT = "id long, v array<long>, bound long, cells array<int>"


def _home(index: Index, filled: np.ndarray):
    """The cell where a query looks first: the filled one nearest by annulus."""
    arrow = arrow_schema(SENT)

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            if batch.num_rows:
                q = index.query(_vectors(batch.column(1)))
                distances = index.to_pivots(q)
                low, high = filled[:, 1], filled[:, 2]
                own = distances[:, (filled[:, 0] // RINGS).astype(int)]
                gap = np.maximum(np.maximum(low - own, own - high), 0) + own * 1e-3
                best = filled[gap.argmin(1), 0].astype(int)
                yield _batch(arrow, id=batch.column(0).to_pylist(),
                             v=batch.column(1).to_pylist(),
                             bound=[None] * len(q), cells=[[int(c)] for c in best])

    return run


def _reach(index: Index, filled: np.ndarray):
    """The cells that may hold something as near as a query's bound, but for its home."""
    arrow = arrow_schema(SENT)

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _vectors(batch.column(1))
            bounds = batch.column(2).to_pylist()
            home = batch.column(3).to_pylist()
            q = index.query(v)
            own = index.to_pivots(q)[:, (filled[:, 0] // RINGS).astype(int)]
            gap = np.maximum(np.maximum(filled[:, 1] - own, own - filled[:, 2]), 0)
            far = _far(index, q, bounds)
            cells = [[int(c) for c in filled[gap[i] <= far[i], 0] if c != home[i][0]]
                     for i in range(len(q))]
            yield _batch(arrow, id=batch.column(0).to_pylist(), v=v.tolist(), bound=bounds,
                         cells=cells)

    return run


def _far(index: Index, q: np.ndarray, bounds: list) -> np.ndarray:
    """The distance of a score that is the query's k-th so far; no bound is infinity."""
    score = np.array([-np.inf if b is None else float(b) for b in bounds])
    square = (q ** 2).sum(1) + index.radius2 - 2 * score
    return np.sqrt(np.maximum(square, 0) * (1 + _SLACK) + _SLACK * (index.radius2 + 1))


FOUND = "query_id long, vec_id long, score long"


def _search(index: Index, k: int):
    """Streams blocks: first a block's vectors, by distance, then the queries sent to it."""
    arrow = arrow_schema(FOUND)

    def block_hits(pivot: int, ids, v, distance, queries: list):
        for start in range(0, len(queries), 512):
            part = queries[start:start + 512]
            qv = np.array([r["v"] for r in part], np.int64)
            qid = np.array([r["id"] for r in part])
            q = index.query(qv)
            own = index.to_pivots(q)[:, pivot]
            far = _far(index, q, [r["bound"] for r in part])
            best = np.full((len(part), k), _LOWEST)
            best_id = np.full((len(part), k), -1)
            steps = np.arange(0, len(ids), STEP)
            low = distance[steps]
            high = distance[np.minimum(steps + STEP, len(ids)) - 1]
            gap = np.maximum(np.maximum(low - own[:, None], own[:, None] - high), 0)
            order = np.argsort(gap, axis=1, kind="stable")
            for turn in range(len(steps)):
                step = order[:, turn]
                active = np.flatnonzero(gap[np.arange(len(part)), step] <= far)
                if not len(active):
                    break
                for s in np.unique(step[active]):
                    rows = active[step[active] == s]
                    some = slice(steps[s], steps[s] + STEP)
                    scores = _products(qv[rows], v[some])
                    scores = np.where(ids[some] == qid[rows][:, None],
                                      _LOWEST, scores)
                    _keep_best(best, best_id, rows, scores, ids[some], k)
                full = best_id[active, k - 1] >= 0
                rows = active[full]
                far[rows] = np.minimum(far[rows], _far(index, q[rows], list(best[rows, k - 1])))
            at = best > _LOWEST
            yield np.repeat(qid, at.sum(1)), best_id[at], best[at]

    def run(batches: Iterator) -> Iterator:
        key, vectors, queries = None, [], []

        def flush():
            if vectors and queries:
                ids = np.array([r["id"] for r in vectors])
                v = np.array([r["v"] for r in vectors], np.int64)
                distance = np.array([r["distance"] for r in vectors])
                for q, x, s in block_hits(key[0] // RINGS, ids, v, distance, queries):
                    yield _batch(arrow, query_id=q, vec_id=x, score=s)

        for batch in batches:
            for row in batch.to_pylist():
                if (row["cell"], row["block"]) != key:
                    yield from flush()
                    key, vectors, queries = (row["cell"], row["block"]), [], []
                if row["kind"] == 0:
                    vectors.append(row)
                else:
                    queries.append(row)
                    if len(queries) >= BLOCK:
                        yield from flush()
                        queries = []
        yield from flush()

    return run


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products; sums may wrap on the way, and are right where the product fits."""
    exact = q @ x.T
    if (np.abs(q).max(initial=0).astype(float) * np.abs(x).max(initial=0).astype(float)
            * q.shape[1] < 2.0 ** 62):
        return exact
    rough = q.astype(float) @ x.astype(float).T
    return np.where(rough >= 2.0 ** 63, _MOST, np.where(rough <= -2.0 ** 63, -_MOST, exact))


def _keep_best(best, best_id, rows, scores, ids, k: int) -> None:
    """Merges new scores into the k best of each row; ties go to the smaller id."""
    scores = np.hstack([best[rows], scores])
    names = np.hstack([best_id[rows], np.broadcast_to(ids, (len(rows), len(ids)))])
    order = np.lexsort((names, ~scores), axis=1)[:, :k]
    best[rows] = np.take_along_axis(scores, order, 1)
    best_id[rows] = np.take_along_axis(names, order, 1)


def whole_vectors(df: DataFrame, id: str, vector: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of the vectors that take part."""
    x = F.col(f"`{vector}`")
    sound = (F.col(f"`{id}`").isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    return df.where(sound).select(
        F.col(f"`{id}`").alias("id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v")
    ).groupBy("id").agg(F.min("v").alias("v"))


def top_k(df: DataFrame, query: Column, id: str = "vec_id", vector: str = "embedding",
          k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest scores of rows where ``query`` holds.

    ``query`` is a condition on the column ``id``.
    """
    spark = arrow_ready(df.sparkSession)
    every = whole_vectors(df, id, vector, scale).checkpoint()
    widths = sorted(r[0] for r in every.select(F.size("v")).distinct().collect())
    found = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for width in widths:
        found = found.unionByName(_top_k(every.where(F.size("v") == width), query, k))
    return found


def _sample(whole: DataFrame) -> np.ndarray:
    """The ``SAMPLE`` vectors with the smallest hashes of their ids, which are found first."""
    hashed = whole.withColumn("hash", F.xxhash64("id"))
    low = hashed.select("hash").orderBy("hash").limit(SAMPLE).collect()
    chosen = hashed.where(F.col("hash") <= low[-1]["hash"]).select("hash", "id", "v").collect()
    return np.array([r["v"] for r in sorted(chosen, key=lambda r: (r["hash"], r["id"]))], np.int64)


def _top_k(whole: DataFrame, query: Column, k: int) -> DataFrame:
    """The search among vectors of one length, of which there are some."""
    spark = whole.sparkSession
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    index = Index(_sample(whole), whole.agg(F.max(square)).first()[0])
    placed = whole.mapInArrow(_place(index), PLACED).checkpoint()
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("distance").alias("low"),
                                       F.max("distance").alias("high")).collect()
    filled = np.array([(r["cell"], r["low"], r["high"]) for r in cells]).reshape(-1, 3)
    blocks = spark.createDataFrame([(r["cell"], -(-r["n"] // BLOCK)) for r in cells],
                                   "cell int, blocks int")
    vectors = (placed.join(F.broadcast(blocks), "cell")
               .select("cell", F.expr("int(pmod(xxhash64(id), blocks))").alias("block"),
                       F.lit(0).alias("kind"), "id", "v", "distance",
                       F.lit(None).cast("long").alias("bound")))

    def search(sent: DataFrame) -> DataFrame:
        queries = (sent.withColumn("cell", F.explode("cells")).join(F.broadcast(blocks), "cell")
                   .withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
                   .select("cell", "block", F.lit(1).alias("kind"), "id", "v",
                           F.lit(None).cast("double").alias("distance"), "bound"))
        return (vectors.unionByName(queries).repartition("cell", "block")
                .sortWithinPartitions("cell", "block", "kind", "distance", "id")
                .mapInArrow(_search(index, k), FOUND))

    asked = whole.where(query).select("id", "v")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = asked.mapInArrow(_home(index, filled), SENT).checkpoint()
    near = (search(first).withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= k).drop("rank").checkpoint())
    bounds = (near.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("low"))
              .where(F.col("n") >= k).select(F.col("query_id").alias("id"), "low"))
    second = (first.join(bounds, "id", "left").select("id", "v", F.col("low").alias("bound"),
                                                      "cells")
              .mapInArrow(_reach(index, filled), SENT))
    return (near.unionByName(search(second)).withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.expr("id % 50 = 0"))


QUERIES = {"op6_topk": op6_topk}
ORACLES = {"op6_topk": """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank
  FROM scores) WHERE rank <= 5"""}
