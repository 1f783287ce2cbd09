"""What many batches share is made once and picked per batch; batches are bounded by bytes."""

from __future__ import annotations

from tickerloom.operators import chat
from tickerloom.session import SESSION_CONF, prepare

GOOD = "Sentiment: Neutral\nDecision: HOLD"


def test_a_batch_takes_its_own_outputs_only(spark):
    responses = spark.createDataFrame(
        [(f"t{i}", f"{GOOD} {i}") for i in range(50)] + [("t1", f"{GOOD} 0"), ("t2", "bad")],
        "input string, output string")
    known = chat.known_outputs(responses).checkpoint()
    assert known.count() == 50
    batch = spark.createDataFrame([("t1",), ("t1",), ("t7",), ("x",), (None,)], "input string")
    labelled = chat.label_from_known(batch, known)
    assert sorted(tuple(r) for r in labelled.collect()) == [
        ("t1", f"{GOOD} 0"), ("t1", f"{GOOD} 0"), ("t7", f"{GOOD} 7")]
    assert "LeftSemi" in labelled._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(chat.label_from_table(batch, responses).collect()) == sorted(labelled.collect())


def test_arrow_batches_are_bounded(spark):
    prepare(spark)
    for name in ("maxRecordsPerBatch", "maxBytesPerBatch"):
        key = f"spark.sql.execution.arrow.{name}"
        assert spark.conf.get(key) == SESSION_CONF[key]
    docs = spark.range(1, 3001, 1, 1).selectExpr("repeat('x', 20000) as input")
    seen = chat.label_batches(docs, lambda p: p + GOOD if len(p) < 1000 else p)
    assert seen.count() == 3000
