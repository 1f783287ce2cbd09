"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickerloom.session import prepare, shared_dir

# Texts, and bytes, in one Arrow batch.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20


def worker_memo(name: str, make: Callable):
    """An object that lives as long as the Python worker.

    Functions shipped by value get fresh globals for every task, so what is
    costly to build hangs on a module of its own.
    """
    holder = sys.modules.setdefault("_tickerloom_memo", types.ModuleType("_tickerloom_memo"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table in a session set up for the operators."""
    return arrow_ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_ready(spark: SparkSession) -> SparkSession:
    """Session settings of the operators: UTC, small Arrow batches, the shared folder.

    Operators checkpoint what they go on with, so the shuffle files of an action go at
    its end and do not wait for the driver's garbage collection.
    """
    prepare(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    shared_dir(spark)
    return spark


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without columns that would clash with result columns."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def extend_schema(df: DataFrame, ddl: str) -> StructType:
    """The schema of ``df`` and further fields."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])


def map_texts(df: DataFrame, text: str, ddl: str,
              rows: Callable[[], Callable[[list[str]], dict]], keep: Iterable[str]) -> DataFrame:
    """Columns ``keep`` and what ``rows()`` makes of each batch of texts.

    ``rows`` runs once in a task and returns a function from a list of texts (a
    null text is empty) to a dict of equally long columns. Rows stay in order.
    """
    kept = [c for c in keep if c != text]
    narrow = df.select(*[F.col(f"`{c}`") for c in kept],
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    schema = extend_schema(narrow.drop("__text"), ddl)
    fields = StructType.fromDDL(ddl)
    arrow = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = rows()
        for batch in batches:
            made = work(batch.column(len(kept)).to_pylist())
            columns = [batch.column(i) for i in range(len(kept))]
            columns += [pa.array(made[f.name], type=f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *arrow.names])

    return narrow.mapInArrow(run, schema)


def arrow_schema(fields: StructType | str) -> pa.Schema:
    """The Arrow schema of Spark fields; one given as DDL needs a session, so not in tasks."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(fields) if isinstance(fields, str) else fields)


# Ids that may be broadcast: about 32 MB as a hash table.
BROADCAST_IDS = 1_000_000


def rows_of(df: DataFrame, ids: DataFrame, id: str) -> DataFrame:
    """Rows of ``df`` whose ``id`` is among ``ids`` (one column of that name, checkpointed).

    The ids are counted; few enough are broadcast, so wide rows are not shuffled,
    and more are joined by a shuffle.
    """
    few = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, id, "left_semi")
