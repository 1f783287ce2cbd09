"""Labelling as a stream of arriving files, resumed by keyed state.

Two streams meet in one stateful step, keyed by the digest of a text: the arriving
inputs, and the labelled records as they are appended. A record marks its key as
labelled, an input whose key is not marked goes on to the labeller. So a batch reads
its own inputs, the records of the batch before, and the state of the keys it
touches (RocksDB), and never the records of all batches.

A batch writes its records to a folder named by the stream and the batch, so one that
is replayed after a crash replaces its own records. A stream whose progress is lost
reads all records once and marks their keys again. Batches are bounded by files per
trigger; each is committed, so a failing labeller keeps the batches before it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tickerloom.operators import filters
from tickerloom.plans.chat_set import LABELLED_SCHEMA, Labeller
from tickerloom.sources import publishing
from tickerloom.sources.runs import run_path

ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def records_as_they_come(spark: SparkSession, path: str) -> DataFrame:
    """The labelled records below ``path`` as a stream; malformed lines are left out."""
    publishing.file_system(spark, path).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(path))
    lines = spark.readStream.option("recursiveFileLookup", True).text(path)
    return lines.select(F.from_json("value", LABELLED_SCHEMA).alias("r")).select(
        "r.input").where("input is not null")


def _unlabelled(inputs: DataFrame, records: DataFrame) -> DataFrame:
    """The inputs whose text no record has had, by keyed state."""
    key = F.sha2("input", 256).alias("__digest")
    both = inputs.select("*", key, F.lit(False).alias("__record")).unionByName(
        records.select(F.lit(None).cast("string").alias("input"), key,
                       F.lit(True).alias("__record")), allowMissingColumns=True)
    fields = inputs.schema.fields
    names = [f.name for f in fields]

    def pending(_, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        # A record in the batch counts before the inputs, so these wait for the last frame.
        held, labelled = [], state.exists
        for frame in frames:
            labelled = labelled or bool(frame["__record"].any())
            if not labelled:
                held.append(frame.loc[~frame["__record"], names])
        if labelled:
            state.update((True,))
        else:
            yield from held

    return both.groupBy("__digest").applyInPandasWithState(
        pending, StructType(fields), "labelled boolean", "append", "NoTimeout")


def incremental_label(spark: SparkSession, arriving: DataFrame, labelled_path: str,
                      checkpoint_path: str, labeller: Labeller) -> StreamingQuery:
    """Start a run over everything that has arrived; it stops by itself.

    ``arriving`` is a streaming frame with an ``input`` column.
    """
    def handle(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        # Off in streams by default; a stateless batch wants its skew handling.
        session.conf.set("spark.sql.adaptive.enabled", "true")
        stream = json.loads(publishing.read_small(session, f"{checkpoint_path}/metadata"))["id"]
        labelled = filters.well_formed(labeller(batch))
        labelled.write.mode("overwrite").option("ignoreNullFields", False).json(
            run_path(labelled_path, f"{stream}-{number}"))

    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS_DB)
    try:
        pending = _unlabelled(filters.non_blank(arriving, "input"),
                              records_as_they_come(spark, labelled_path))
        return (pending.writeStream.foreachBatch(handle)
                .option("checkpointLocation", checkpoint_path)
                .trigger(availableNow=True).start())
    finally:
        spark.conf.set(PROVIDER, before)


def arriving_json(spark: SparkSession, path: str, schema: str,
                  files_per_batch: int | None = None) -> DataFrame:
    """JSON-lines files as they arrive; malformed lines become blank inputs."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)
