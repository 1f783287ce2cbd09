"""Whitening of embeddings by shifted CholeskyQR.

Vectors become whole numbers x = floor(scale * c) + offset, so their number n, sums
S and deviations are exact. A distributed Gram pass over the centred rows gives the
matrix whose Cholesky factor, taken with a small shift, is the first R. Each further
pass solves the rows through all triangles so far and takes the Gram matrix of what
comes out, until that is the identity (or zero, in directions the rows do not
have). The product of the triangles is the R of the centred rows; its singular
vectors are the components and its squared singular values, over n, the
eigenvalues of the covariance, found without ever squaring the condition of the rows.

A Gram pass sends one matrix per task, summed by a few tasks before the driver sees
it, so what travels depends on the width of the vectors, not on their number.

Defined results: rows whose vector is null, empty, or holds a null or non-finite
component, or one that gives no x in 62 bits, take no part; a null id stays;
repeated rows count each; vectors of different lengths are whitened length by
length, each with its own n; directions in which the vectors do not vary (singular
value below ``RANK`` of the largest) have no component, so equal vectors or a
single one give no rows; a deviation that no long holds is null; components are
turned so that their largest entry is positive; columns other than id and vector
are not read, so clashing names do no harm.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StructField, StructType,
)

from tickerloom.llm.common import arrow_ready, arrow_schema, table

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
RANK = 1e-9  # singular values below this part of the largest are none
NEAR = 1e-10  # how near to the identity the last Gram matrix has to be
PASSES = 12  # at most; two or three are usual
MERGERS = 16  # tasks that add up the parts of a pass
_HELD = float(1 << 62)


def whole_vectors(df: DataFrame, id: str, vector: str, scale: int, offset: int) -> DataFrame:
    """(id, x, width) of the vectors that take part."""
    c = F.col(f"`{vector}`")
    sound = c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e)
                                                      & (F.abs(e) * scale < _HELD - offset))
    return df.where(sound).select(
        F.col(f"`{id}`").alias("id"),
        F.transform(c, lambda e: F.floor(e.cast("double") * scale) + offset).alias("x"),
        F.size(c).alias("width"))


def matrix(column) -> np.ndarray:
    """An Arrow list column of equally long lists as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fold(df: DataFrame, work: Callable, merge: Callable):
    """``merge`` of what ``work`` makes of each task's batches, as bytes; None without rows.

    Tasks send one part each, ``MERGERS`` tasks merge them, the driver the rest.
    """
    import pyarrow as pa

    def one(made):
        return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["part"])

    def parts(batches: Iterator) -> Iterator:
        made = work(b for b in batches if b.num_rows)
        if made is not None:
            yield one(made)

    def merged(batches: Iterator) -> Iterator:
        made = None
        for batch in batches:
            for part in batch.column(0).to_pylist():
                made = part if made is None else merge(made, part)
        if made is not None:
            yield one(made)

    out = None
    for row in (df.mapInArrow(parts, "part binary").repartition(MERGERS)
                .mapInArrow(merged, "part binary").collect()):
        out = bytes(row["part"]) if out is None else merge(out, bytes(row["part"]))
    return out


def _add(a: bytes, b: bytes) -> bytes:
    return (np.frombuffer(a) + np.frombuffer(b)).tobytes()


def statistics(rows: DataFrame) -> tuple[int, list[int], int]:
    """n, the sums and the range of the entries, exactly."""
    def work(batches):
        n, sums, low, high = 0, None, None, None
        for batch in batches:
            x = matrix(batch.column(1))
            least, most = int(x.min()), int(x.max())
            if max(-least, most) >= 1 << 50:
                x = x.astype(object)
            part = [int(s) for s in x.sum(0)]
            n += len(x)
            sums = part if sums is None else [a + b for a, b in zip(sums, part)]
            low = least if low is None else min(low, least)
            high = most if high is None else max(high, most)
        return None if sums is None else json.dumps([n, sums, low, high]).encode()

    def merge(a: bytes, b: bytes) -> bytes:
        (n, s, low, high), (m, t, lower, higher) = json.loads(a), json.loads(b)
        return json.dumps([n + m, [x + y for x, y in zip(s, t)], min(low, lower),
                           max(high, higher)]).encode()

    n, sums, low, high = json.loads(fold(rows, work, merge))
    return n, sums, high - low


class Centred:
    """Centred rows: n * x - S, exact, and divided by n."""

    def __init__(self, n: int, sums: list[int], spread: int):
        self.n, self.sums = n, sums
        self.small = n * (spread + 1) < 1 << 62 and max(map(abs, sums)) < 1 << 62

    def whole(self, x: np.ndarray) -> np.ndarray:
        if self.small:  # a product may wrap, the difference is right all the same
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def real(self, x: np.ndarray) -> np.ndarray:
        return (self.whole(x) / self.n).astype(float)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of squares; exact, as wrapping sums are right where the result fits."""
        whole = self.whole(x)
        rough = (whole.astype(float) ** 2).sum(1)
        if self.small:
            out = (whole * whole).sum(1).tolist()
        else:
            out = [0] * len(whole)
        for i in np.flatnonzero(rough >= _HELD) if self.small else range(len(whole)):
            exact = sum(int(v) ** 2 for v in whole[i])
            out[i] = exact if exact < 1 << 63 else None
        return out


def solved(rows: np.ndarray, triangles: list[np.ndarray]) -> np.ndarray:
    """Rows times the inverses of upper triangles, column by column."""
    for r in triangles:
        q = np.empty_like(rows)
        for j in range(len(r)):
            q[:, j] = (rows[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
        rows = q
    return rows


def gram(rows: DataFrame, centred: Centred, triangles: list[np.ndarray]) -> np.ndarray:
    width = len(centred.sums)

    def work(batches):
        total = None
        for batch in batches:
            q = solved(centred.real(matrix(batch.column(1))), triangles)
            total = q.T @ q if total is None else total + q.T @ q
        return None if total is None else total.tobytes()

    return np.frombuffer(fold(rows, work, _add)).reshape(width, width)


def cholesky(g: np.ndarray) -> np.ndarray:
    """The upper factor of ``g`` with the smallest shift that gives one."""
    shift = len(g) * np.finfo(float).eps * np.trace(g) / len(g)
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift *= 10


def components(rows: DataFrame, centred: Centred, limit: int):
    """Eigenvectors (as columns), eigenvalues and the trace of the covariance."""
    triangles: list[np.ndarray] = []
    for turn in range(PASSES):
        g = gram(rows, centred, triangles)
        if not np.trace(g):
            return np.zeros((len(g), 0)), np.zeros(0), 0.0
        triangles.append(cholesky(g))
        values = np.linalg.eigvalsh(g)
        if turn and (np.minimum(np.abs(values), np.abs(values - 1)) < NEAR).all():
            break
    r = triangles[0]
    for more in triangles[1:]:
        r = more @ r
    _, sigma, w = np.linalg.svd(r)
    rank = int((sigma > RANK * sigma[0]).sum())
    v = w[:min(rank, limit)].T
    v = v * np.sign(v[np.abs(v).argmax(0), np.arange(v.shape[1])])
    e = sigma ** 2 / centred.n
    return v, e[:v.shape[1]], float(e.sum())


def identity_error(rows: DataFrame, centred: Centred, back: np.ndarray) -> float:
    """The largest entry of the covariance of the whitened rows minus the identity."""
    k = back.shape[1]

    def work(batches):
        total = None
        for batch in batches:
            w = centred.real(matrix(batch.column(1))) @ back
            part = np.vstack([w.T @ w, w.sum(0)])
            total = part if total is None else total + part
        return None if total is None else total.tobytes()

    total = np.frombuffer(fold(rows, work, _add)).reshape(k + 1, k) / centred.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def _whitened(rows: DataFrame, schema: StructType, limit: int) -> DataFrame | None:
    """The result for vectors of one length."""
    centred = Centred(*statistics(rows))
    v, e, trace = components(rows, centred, limit)
    if not len(e):
        return None
    back = v / np.sqrt(e)
    error = identity_error(rows, centred, back)
    explained = e / trace
    arrow = arrow_schema(schema)
    k = len(e)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1))
            place = np.repeat(np.arange(len(x)), k)
            columns = [batch.column(0).take(pa.array(place)),
                       np.tile(np.arange(1, k + 1), len(x)),
                       np.full(len(place), centred.n),
                       pa.array(centred.deviations(x), pa.int64()).take(pa.array(place)),
                       (centred.real(x) @ back).ravel(),
                       np.tile(explained, len(x)), np.full(len(place), error)]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type)
                 for c, f in zip(columns, arrow)], names=arrow.names)

    return rows.select("id", "x").mapInArrow(run, schema)


def whitened(df: DataFrame, id: str = "vec_id", vector: str = "embedding",
             limit: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """One row per vector that takes part and component up to ``limit``."""
    spark = arrow_ready(df.sparkSession)
    rows = whole_vectors(df, id, vector, scale, offset)
    schema = StructType([
        StructField(id, df.schema[id].dataType), StructField("component", IntegerType()),
        StructField("n", LongType()), StructField("deviation", LongType()),
        *[StructField(c, DoubleType()) for c in ("whitened", "explained", "identity_error")]])
    widths = sorted(r["width"] for r in rows.groupBy("width").count().collect())
    made = [_whitened(rows.where(F.col("width") == w), schema, limit) for w in widths]
    found = spark.createDataFrame([], schema)
    for part in made:
        found = found if part is None else found.unionByName(part)
    return found


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


QUERIES = {"op11_whitening": op11_whitening}
ORACLES: dict[str, str] = {}
