"""Appended outputs, one folder per run, with a log of what each run has done.

A run writes its rows to ``<output>/run=<id>`` and then its keys to the log beside
them. Before it begins it notes its id and its keys as an intent; a run that finds
the intent of one that died takes that id and those keys and writes the same folder
anew. So a repeated run adds nothing twice, and nobody looks through old rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickerloom.sources import publishing
from tickerloom.sources.readers import read_jsonl_lenient, rows_or_none

LOG, INTENT, INTENDED = "_log", "_intent", "_intended"


def run_path(output: str, run: str) -> str:
    return f"{output}/run={run}"


def logged(spark: SparkSession, output: str, schema: str) -> DataFrame:
    """The keys of all finished runs."""
    return rows_or_none(spark, lambda: spark.read.schema(schema).option(
        "recursiveFileLookup", True).parquet(f"{output}/{LOG}"), schema)


class Run:
    """One idempotent run: ``keys`` of this run, then ``write`` its rows, then ``finish``."""

    def __init__(self, spark: SparkSession, output: str, pending: Callable[[], DataFrame],
                 schema: str):
        self.spark, self.output = spark, output
        died = publishing.read_small(spark, f"{output}/{INTENT}")
        self.run = died or uuid.uuid4().hex
        intended = f"{output}/{INTENDED}/{self.run}"
        if not died:
            pending().write.mode("overwrite").parquet(intended)
            publishing.put_small(spark, f"{output}/{INTENT}", self.run)
        self.keys = spark.read.schema(schema).parquet(intended)

    def write(self, rows: DataFrame) -> None:
        rows.write.mode("overwrite").option("ignoreNullFields", False).json(
            run_path(self.output, self.run))

    def finish(self) -> None:
        self.keys.write.mode("overwrite").parquet(f"{self.output}/{LOG}/{self.run}")
        publishing.remove(self.spark, f"{self.output}/{INTENT}")
        publishing.remove(self.spark, f"{self.output}/{INTENDED}")


DIGEST = "digest binary"


def digest(text: str):
    """A text's SHA-256 in 32 bytes."""
    return F.unhex(F.sha2(F.col(f"`{text}`"), 256))


class LabelledRuns:
    """Labelled records in runs, with the digests of their inputs logged run by run.

    Which inputs have a label is read off the digests. Records of a run without a
    log, which died before it was written, are read once, to write it; records that
    lie in the folder itself, without a run, are read each time.
    """

    def __init__(self, spark: SparkSession, output: str, schema: str, text: str = "input"):
        self.spark, self.output, self.schema, self.text = spark, output, schema, text

    def _names(self, folder: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = publishing.file_system(self.spark, folder)
        if not system.exists(path):
            return []
        return sorted(s.getPath().getName() for s in system.listStatus(path))

    def digests(self) -> DataFrame:
        """One row per digest of a labelled input; logs what a dead run has left."""
        names = self._names(self.output)
        runs = [n.removeprefix("run=") for n in names if n.startswith("run=")]
        missing = set(runs) - set(self._names(f"{self.output}/{LOG}"))
        for run in sorted(missing):
            if "_SUCCESS" in self._names(run_path(self.output, run)):
                self._log(run, read_jsonl_lenient(
                    self.spark, run_path(self.output, run), self.schema))
            else:  # its rows were being written
                publishing.remove(self.spark, run_path(self.output, run))
        known = logged(self.spark, self.output, DIGEST)
        loose = [f"{self.output}/{n}" for n in names if not n.startswith(("run=", "_", "."))]
        if loose:
            old = read_jsonl_lenient(self.spark, loose, self.schema)
            known = known.unionByName(old.select(digest(self.text).alias("digest")))
        return known.where("digest is not null").distinct()

    def _log(self, run: str, rows: DataFrame) -> None:
        rows.select(digest(self.text).alias("digest")).distinct().write.mode(
            "overwrite").parquet(f"{self.output}/{LOG}/{run}")

    def pending(self, inputs: DataFrame) -> DataFrame:
        """Inputs without a label; copies among them all stay."""
        return inputs.withColumn("digest", digest(self.text)).join(
            self.digests(), "digest", "left_anti").drop("digest")

    def append(self, rows: DataFrame, run: str | None = None) -> int:
        """Write the rows of a run, log them, and count them while they are written."""
        run = run or uuid.uuid4().hex
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option(
            "ignoreNullFields", False).json(run_path(self.output, run))
        self._log(run, read_jsonl_lenient(self.spark, run_path(self.output, run), self.schema))
        return seen.get["n"]
