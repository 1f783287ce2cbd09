"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Timestamps are rendered in the session zone, so the zone has to be UTC.
# Case sensitivity is turned on by the ingest flow only.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Long texts: a batch is bounded by its bytes, so a Python worker's memory is too.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  memory: str = "12g", app: str = "tickerloom") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a folder of its own; a cluster without the setting is an
    error, because executors could not see a driver-local folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not context.getCheckpointDir():
            context.setCheckpointDir(configured)
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    current = context.getCheckpointDir()
    if current is None:
        current = tempfile.mkdtemp(prefix="tickerloom-")
        context.setCheckpointDir(current)
    return current
