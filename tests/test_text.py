import html
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickerloom.functions import labels as L
from tickerloom.functions import text as X

CASES = [
    ("<b>It's</b> &amp; they're", "it is & they are"),
    ("couldn't", "couldn't"),
    ("donâ€™t", "don tmt"),
    ("ﬁ", "fi"),
    ("a b", "a b"),
    (None, ""),
    ("xâyÃz", "x y z"),
    ("&lt;b&gt; stays", "<b> stays"),
    ("dont’t won’t", "dontt wont"),
    ("He'd've  CAN'T\tWon't n't x'm", "he would have cannot will not not x am"),
    ("they\x1care", "they are"),
    ("１２ Ａ", "12 a"),
    ("café", "caf"),
    ("a < b", "a < b"),
]


def run(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.v for r in fn(df).orderBy("i").collect()]


def test_normalize_literals(spark):
    got = run(spark, [c[0] for c in CASES], lambda df: X.normalize_text(df, ["v"]))
    assert got == [c[1] for c in CASES]


def test_repair_mojibake_is_optional(spark):
    got = run(spark, ["donâ€™t"], lambda df: X.normalize_text(df, ["v"], repair_mojibake=True))
    assert got == ["do not"]


@pytest.mark.parametrize("value, plain", [
    ("isn't", "is not"), ("ISN'T it", "is not it"), ("xisn't", "xisn't"), ("it's", "it is"),
    ("there's", "there is"), ("we've", "we have"), ("'ve", "'ve"), ("n't", " not"),
])
def test_contractions(spark, value, plain):
    got = run(spark, [value], lambda df: df.withColumn("v", X.expand_contractions(F.col("v"))))
    assert got == [plain]


def test_python_steps_match_the_standard_library(spark):
    values = ["&eacute; &amp;amp; &notit; &#65;&copy", "ﬁ Ⅷ ½ é é アﾞ", "plain", "한글 中文 кот"]
    got = run(spark, values, lambda df: df.withColumn("v", X.unescape_entities(F.col("v"))))
    assert got == [html.unescape(v) for v in values]
    got = run(spark, values, lambda df: df.withColumn("v", X.nfkc(F.col("v"))))
    assert got == [unicodedata.normalize("NFKC", v) for v in values]


def test_texts_that_need_no_python_are_recognised(spark):
    values = ["ascii", "élan über", "中文", "ﬁ", "é", "½"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r.n for r in df.select("i", X.needs_nfkc(F.col("v")).alias("n")).orderBy("i").collect()]
    assert got == [False, False, False, True, True, True]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=40), min_size=20, max_size=60))
def test_nfkc_gate_never_skips_a_change(spark, values):
    values = [v.replace("\x00", "").encode("utf-8", "ignore").decode() for v in values]
    got = run(spark, values, lambda df: df.withColumn("v", X.nfkc(F.col("v"))))
    assert got == [unicodedata.normalize("NFKC", v) for v in values]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("abc XYZ.,1\t\n", max_size=40), min_size=5, max_size=40))
def test_normalize_is_idempotent_on_plain_text(spark, values):
    once = run(spark, values, lambda df: X.normalize_text(df, ["v"]))
    assert run(spark, once, lambda df: X.normalize_text(df, ["v"])) == once
    assert once == [" ".join(v.lower().split()) for v in values]


def test_only_the_gated_steps_leave_the_jvm(spark):
    df = spark.createDataFrame([("a",)], "v string")
    plan = X.normalize_text(df, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in plan


def test_title_case_and_missing_labels(spark):
    values = ["POSITIVE", " very-positive ", "nan", "None", "", None, "it's 3rd", "éCLAIR"]
    got = run(spark, values, lambda df: df.withColumn("v", L.title_case(F.col("v"))))
    assert got == [v if v is None else v.strip().title() for v in values]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    missing = [r.m for r in df.select("i", L.is_missing_label(F.col("v")).alias("m"))
               .orderBy("i").collect()]
    assert missing == [False, False, True, True, True, True, False, False]


def test_numeric_sentiment(spark):
    values = ["-1", "-1.0", "0", "1", "0.5", "good", None, "1f", " 1 "]
    got = run(spark, values, lambda df: df.withColumn("v", L.map_numeric_sentiment(F.col("v"))))
    assert got == ["Negative", "Negative", "Neutral", "Positive", "0.5", "good", None, "1f",
                   "Positive"]


def test_label_block(spark):
    block = "Sentiment: Bullish\nConfidence: high\nSummary:\nDecision:\tBUY "
    df = spark.createDataFrame([(block,), ("Sentiment: x",), (None,)], "b string")
    first = df.select(*[c.alias(n) for n, c in L.label_block_columns(F.col("b")).items()]).first()
    assert (first.sentiment, first.confidence, first.summary, first.decision, first.horizon) == (
        "Bullish", None, None, "BUY", None)
    assert [r[0] for r in df.select(L.is_well_formed_block(F.col("b"))).collect()] == [
        True, False, False]
