"""Outputs that change all at once.

An output folder holds runs. A run writes below a folder of its own, which no
reader looks at until the run is committed: a pointer file that names it is put in
place by one atomic rename. Readers ask the pointer first, so they see the whole
old output or the whole new one. The run before stays on disk for those who have
begun to read it, older ones go. A run that fails leaves the pointer as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

POINTER = "current.run"


def _path(spark: SparkSession, place: str):
    return spark._jvm.org.apache.hadoop.fs.Path(place)


def file_system(spark: SparkSession, place: str):
    """The Hadoop file system that ``place`` lies in."""
    return _path(spark, place).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def remove(spark: SparkSession, place: str) -> None:
    file_system(spark, place).delete(_path(spark, place), True)


def read_small(spark: SparkSession, place: str) -> str | None:
    """The text of a small file, None if there is none."""
    system, path = file_system(spark, place), _path(spark, place)
    if not system.exists(path):
        return None
    stream = system.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_small(spark: SparkSession, place: str, text: str) -> None:
    """Write a small file and rename it into place, over an older one."""
    jvm, path = spark._jvm, _path(spark, place)
    beside = _path(spark, f"{place}.{uuid.uuid4().hex}")
    system = file_system(spark, place)
    system.mkdirs(path.getParent())
    stream = system.create(beside, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.makeQualified(path).toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    context.rename(system.makeQualified(beside), system.makeQualified(path), options)


def run_folder(output: str, run: str) -> str:
    return f"{output.rstrip('/')}/runs/{run}"


def committed(spark: SparkSession, output: str) -> str | None:
    """The folder of the committed run, None before the first one."""
    text = read_small(spark, f"{output.rstrip('/')}/{POINTER}")
    return run_folder(output, text.split("\n")[0]) if text else None


class Publication:
    """One run: write below ``folder``, then ``commit``; leaving with an error removes it."""

    def __init__(self, spark: SparkSession, output: str):
        self.spark, self.output = spark, output.rstrip("/")
        self.run = uuid.uuid4().hex
        self.folder = run_folder(output, self.run)

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is not None:
            remove(self.spark, self.folder)

    def commit(self) -> None:
        pointer = f"{self.output}/{POINTER}"
        before = (read_small(self.spark, pointer) or "").split("\n")
        put_small(self.spark, pointer, f"{self.run}\n{before[0]}")
        for old in filter(None, before[1:]):
            remove(self.spark, run_folder(self.output, old))
