"""From raw texts to labelled texts to chat records, resumable."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickerloom.operators import chat, filters, joins
from tickerloom.session import shared_dir
from tickerloom.sources import readers, sinks
from tickerloom.sources.runs import LabelledRuns

INPUT_SCHEMA = "input string"
LABELLED_SCHEMA = "input string, output string"

# Texts a labeller gets at a time; a failure loses no more than one batch.
BATCH_ROWS = 100_000

Labeller = Callable[[DataFrame], DataFrame]


def pending_texts(inputs: DataFrame, labelled: DataFrame) -> DataFrame:
    """Non-blank inputs without a label; a missing text counts as blank."""
    return joins.skip_labelled(filters.non_blank(inputs, "input"), labelled)


def label_pending(inputs: DataFrame, labelled: DataFrame, labeller: Labeller) -> DataFrame:
    """Newly labelled rows with a well-formed ``output``, extra fields kept."""
    return filters.well_formed(labeller(pending_texts(inputs, labelled)))


class LabellingStopped(RuntimeError):
    """A labeller failed; what was labelled before is kept."""

    def __init__(self, newly_labelled: int, chat_records: int):
        super().__init__(f"stopped after {newly_labelled} new labels; "
                         f"{chat_records} chat records are written")
        self.newly_labelled, self.chat_records = newly_labelled, chat_records


def label_in_batches(inputs: DataFrame, runs: LabelledRuns, labeller: Labeller,
                     batch_rows: int) -> tuple[int, Exception | None]:
    """Label what is pending in batches of about ``batch_rows``, each committed.

    Copies of a text share a batch. Returns how many rows got a label and the error
    that stopped the run, if one did; the batches before it stay.
    """
    pending = runs.pending(filters.non_blank(inputs, "input")).checkpoint()
    batches = -(-pending.count() // batch_rows)
    number = F.pmod(F.xxhash64("input"), F.lit(batches))
    done = 0
    for batch in range(batches):
        rows = pending.where(number == batch) if batches > 1 else pending
        try:
            done += runs.append(filters.well_formed(labeller(rows)))
        except Exception as error:
            return done, error
    return done, None


def chat_training_set(spark: SparkSession, inputs_path: str, labelled_path: str,
                      chat_path: str, labeller: Labeller,
                      input_schema: str = INPUT_SCHEMA,
                      batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Label what is new, append it, rewrite the chat file; returns the counts.

    If the labeller fails, the batches before are kept and become chat records, and
    LabellingStopped is raised; the next run goes on with what is missing.
    """
    shared_dir(spark)
    inputs = readers.read_jsonl_lenient(spark, inputs_path, input_schema)
    runs = LabelledRuns(spark, labelled_path, LABELLED_SCHEMA)
    newly, error = label_in_batches(inputs, runs, labeller, batch_rows)
    every = readers.read_jsonl_lenient(spark, labelled_path, LABELLED_SCHEMA)
    seen = Observation()
    sinks.overwrite_jsonl(chat.to_chat_messages(every).select("messages").observe(
        seen, F.count(F.lit(1)).alias("n")), chat_path)
    records = seen.get["n"]
    if error is not None:
        raise LabellingStopped(newly, records) from error
    return spark.createDataFrame([(newly, records)], "newly_labelled long, chat_records long")
