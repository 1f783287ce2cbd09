import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Row

from tickerloom.operators import columns as P
from tickerloom.operators import dedup, filters, joins, matching, ranking, roles
from tickerloom.operators.aggregates import kept_per_group
from tickerloom.operators.numbering import global_row_number
from tickerloom.sources import dims


def test_dedup_protects_unlabelled_rows_and_files(spark):
    rows = [("f", "a", "Pos"), ("f", "a", "Pos"), ("g", "a", "Pos"), ("f", "b", None),
            ("f", "b", None), ("f", "c", " NaN "), ("f", "c", " NaN "), ("f", "d", "none")]
    df = spark.createDataFrame(rows, "file string, text string, label string")
    got = Counter(map(tuple, dedup.dedup_keep_unlabelled(df, ["label"]).collect()))
    assert got == Counter({("f", "a", "Pos"): 1, ("g", "a", "Pos"): 1, ("f", "b", None): 2,
                           ("f", "c", " NaN "): 2, ("f", "d", "none"): 1})
    again = dedup.dedup_keep_unlabelled(df, ["label"])
    assert dedup.dedup_keep_unlabelled(again, ["label"]).count() == 6 + 1
    assert dedup.dedup_keep_unlabelled(df, []).count() == 5


def test_dedup_treats_nan_and_zero_signs_alike(spark):
    df = spark.createDataFrame([(float("nan"),), (float("nan"),), (0.0,), (-0.0,), (None,), (None,)],
                               "x double")
    assert dedup.dedup_rows(df).count() == 3


def test_top_k_with_a_hot_group(spark):
    rng = random.Random(3)
    rows = [(("hot" if i % 3 else f"g{i % 50}"), rng.randrange(1000), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, i int")
    got = ranking.top_k_per_group(df, ["g"], [F.desc("v"), F.asc("i")], 5, salt_on=["i"])
    want = defaultdict(list)
    for g, v, i in sorted(rows, key=lambda r: (-r[1], r[2])):
        want[g].append((v, i))
    found = defaultdict(list)
    for r in got.orderBy("g", "rank").collect():
        found[r.g].append((r.v, r.i))
    assert found == {g: rows[:5] for g, rows in want.items()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4


def test_first_seen_keeps_the_first_even_if_it_fails_later(spark):
    df = spark.createDataFrame([("T", "u", 0, 1, None), ("T", "u", 1, 1, "2020-01-01"),
                                ("S", "u", 1, 1, "2020-01-01")],
                               "ticker string, url string, kw_idx int, rank int, d string")
    first = ranking.first_seen(df, ["ticker", "url"], ["kw_idx", "rank"])
    kept = filters.valid_news(first, "url", "d").collect()
    assert [r.ticker for r in kept] == ["S"]


def test_global_row_numbers_are_dense_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("x")).repartition(7)
    rows = global_row_number(df, [F.asc("x")], "n").orderBy("x").collect()
    assert [r.n for r in rows] == list(range(1, 5001))


def test_search_terms_and_resume(spark):
    companies = dims.ticker_dim(spark)
    terms = joins.search_terms(companies, list(enumerate(dims.KEYWORDS)))
    assert terms.count() == 1000
    one = terms.where("ticker = 'M&M.NS' and kw_idx = 5").first()
    assert one.search_term == '"Mahindra and Mahindra" quarter results'
    done = spark.createDataFrame([("M&M.NS",)], "ticker string")
    left = joins.skip_completed(companies, done, "ticker")
    assert left.count() == 49
    assert joins.skip_completed(left, companies, "ticker").count() == 0
    inputs = spark.createDataFrame([("a",), ("a",), ("b",), ("A",)], "input string")
    kept = joins.skip_labelled(inputs, spark.createDataFrame([("b",)], "input string"))
    assert sorted(r.input for r in kept.collect()) == ["A", "a", "a"]
    assert joins.skip_labelled(kept, kept).count() == 0


def test_match_news_whole_words_any_case(spark):
    docs = spark.createDataFrame([
        (1, "TATA Steel posts quarter results"), (2, "tata steelworks profit"),
        (3, "Profit at Tata-Steel; loss at ITC Limited"), (4, "profit"), (5, "Tata Steel"),
        (6, "")], "doc_id long, text string")
    got = {(r.doc_id, r.ticker, dims.KEYWORDS[r.kw_idx]) for r in matching.match_news(
        docs, dims.ticker_dim(spark), dims.keyword_dim(spark)).collect()}
    assert got == {(1, "TATASTEEL.NS", "quarter results"),
                   (3, "TATASTEEL.NS", "profit"), (3, "TATASTEEL.NS", "loss"),
                   (3, "ITC.NS", "profit"), (3, "ITC.NS", "loss")}


def test_zero_groups_are_reported(spark):
    groups = spark.createDataFrame([("a",), ("b",)], "g string")
    kept = spark.createDataFrame([("a", 1), ("a", 2)], "g string, x int")
    assert {r.g: r.saved for r in kept_per_group(groups, kept, ["g"]).collect()} == {"a": 2, "b": 0}


def test_column_operators(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["Text", "Unnamed: 1", "_c2", " Publish Date "])
    assert P.rename_columns(df, {"Text": "text", "none": "x"}).columns[0] == "text"
    assert P.drop_unnamed(df).columns == ["Text", " Publish Date "]
    assert P.drop_columns(df, ["Text", "absent"]).columns == df.columns[1:]
    assert P.canonical_names(df).columns[3] == "date"
    with pytest.raises(ValueError):
        P.canonical_names(spark.createDataFrame([(1, 2)], ["label", "sentiment"]))


def test_symbol_and_stem(spark):
    df = spark.createDataFrame([("file:/d/Nifty 50/A.B.csv",), ("file:/d/x/C.csv",)], "p string")
    got = [r.Symbol for r in P.inject_symbol(df, F.col("p")).collect()]
    assert got == ["A.B", None]


def test_text_choice(spark):
    rows = [("t", "p", "d", " " + "x" * 301 + "\n"), ("t", "p", "d", "x" * 300), (None, "p", "", None)]
    df = spark.createDataFrame(rows, "t string, p string, d string, f string")
    got = [r[0] for r in df.select(P.choose_text(*[F.col(c) for c in "tpdf"])).collect()]
    assert got == ["x" * 301, "t | p | d", " | p | "]


def test_unpivot(spark):
    df = spark.createDataFrame([("d1", "a", None), ("d2", None, "b")], "Date string, h1 string, h2 string")
    assert sorted(map(tuple, P.unpivot_headlines(df, "Date").collect())) == [("d1", "a"), ("d2", "b")]


def test_roles(spark):
    rows = [Row(id="1", when="2020-01-01", created="x", Headline="h", news_sentiment="a", width="2")]
    got = roles.infer_roles(spark.createDataFrame(rows))
    assert got == roles.Roles("created", ("Headline",), ("news_sentiment",))
    dated = [Row(id="1", created="x", updated="2020-01-01", body="b", score=1.0)]
    assert roles.infer_roles(spark.createDataFrame(dated)).date == "updated"
    plain = [Row(body="some words", when="01/02/2020")] * 3
    assert roles.infer_roles(spark.createDataFrame(plain)).date == "when"
    none = [Row(body="some words", n=1)]
    assert roles.infer_roles(spark.createDataFrame(none)).date is None
    import datetime as dt
    typed = [Row(when=dt.datetime(2020, 1, 1), day="2020-01-01")]
    assert roles.infer_roles(spark.createDataFrame(typed)).date == "when"


def test_best_score_and_restored_order(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 1)], "name string, score int")
    assert ranking.best_score(df, "score", "name").first().name == "a"
    placed = df.unionByName(df).withColumn("place", F.monotonically_increasing_id())
    first = dedup.dedup_keep_unlabelled(placed, [], "place")
    assert first.orderBy("place").drop("place").collect() == df.collect()
