"""Exact top-k, main-text extraction, and the pipeline's stages."""

import html
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickerloom.llm import crf, topk
from tickerloom.llm.catalog import all_oracles, all_queries
from tests.oracle import connect, differences


def brute_top(vectors, queries, k):
    out = {}
    for q in queries:
        scores = sorted((-int(vectors[q] @ v), i) for i, v in vectors.items() if i != q)[:k]
        out[q] = [(i, -s) for s, i in scores]
    return out


@pytest.mark.parametrize("kind", ["spread", "clustered", "equal", "long and short"])
def test_top_k_equals_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    draw = np.random.default_rng(3)
    v = draw.normal(size=(600, 6))
    if kind == "clustered":
        v = v / 20 + 5 * np.eye(6)[np.arange(600) % 5]
    if kind == "equal":
        v[100:500] = v[100]
    if kind == "long and short":
        v *= 10 ** draw.uniform(-2, 2, 600)[:, None]
    rows = [(i, [float(x) for x in one], "x") for i, one in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    got = {}
    for r in topk.top_k(df, F.expr("id % 20 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    whole = {i: np.floor(256 * one).astype(np.int64) for i, one in enumerate(v)}
    assert got == brute_top(whole, range(0, 600, 20), 5)


def test_top_k_leaves_unsound_vectors_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [nan, 1.0]),
            (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (None, [1.0, 1.0]), (7, [0.0, 0.0]),
            (8, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"])
           for r in topk.top_k(df, F.expr("id % 50 = 0")).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 128 * 256), (0, 2, 7, 0)]
    assert df.where("vec_id = 8").count() == 1  # alone in its length
    assert topk.top_k(df.limit(0), F.expr("id % 50 = 0")).count() == 0


def test_top_k_of_large_components_and_several_lengths(spark):
    """Exact where a score fits a long, though norms do not; the nearest long where not."""
    big = [2e7, 1.0, -2e7, 3e15, 1e30, 0.5, 7.25, -3e15]
    rows = [(i, [b, float(i)]) for i, b in enumerate(big)]
    rows += [(100 + i, [float(i), 1.0, 2.0]) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in topk.top_k(df, F.expr("id % 50 <= 5")).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    most = 2 ** 63 - 1
    for length in (2, 3):
        whole = {i: [max(-most - 1, min(most, int(np.floor(256 * x)))) for x in v]
                 for i, v in rows if len(v) == length}
        for q in (i for i in whole if i % 50 <= 5):
            scores = sorted((-max(-most, min(most, sum(a * b for a, b in zip(whole[q], v)))), i)
                            for i, v in whole.items() if i != q)[:5]
            assert got[q] == [(i, -s) for s, i in scores]


def by_article(page):
    inner = page[page.index("<article>") + 9:page.index("</article>")]
    parts = re.split(r"</?(?:p|h[1-6]|br|ul|li|table|tr|td|th|pre|blockquote|div)\b[^>]*>", inner)
    texts = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in parts)
    return " ".join(t for t in texts if t)


def test_main_text_of_the_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    chain = crf.fit(pages, fit_pages=12)
    rows = {r["page_id"]: r for r in crf.main_text(pages, chain).collect()}
    for r in pages.collect():
        assert rows[r["page_id"]]["text"] == by_article(r["html"])
        assert rows[r["page_id"]]["n_chars"] == len(rows[r["page_id"]]["text"])
    other = ('<body><div id="cookie-note">We use cookies to serve you.</div><ul class="menu"><li>'
             '<a href="/">Home</a></li></ul><main><h1>Title</h1><p>A first paragraph &amp; more of '
             'it follows here.</p><p>A second paragraph of the same text.</p></main><div '
             'class="comments"><p>I liked reading this a lot.</p></div><footer>&copy; us</footer>')
    assert chain.text(other) == ("Title A first paragraph & more of it follows here. "
                                 "A second paragraph of the same text.")


def test_odd_pages(spark):
    chain = crf.Chain()
    for page in ("", "<", "<p", "<p class='", "</p></div>", "<script>x", "<!-- x", "a & b &lt; c",
                 "<p>" * 3000, "<a b=\"c>d"):
        chain.text(page)
    df = spark.createDataFrame([(1, None, "x"), (1, "", "x")], "page_id long, html string, text string")
    assert [r["text"] for r in crf.main_text(df, chain).collect()] == ["", ""]
    assert crf.main_text(df, crf.fit(df)).count() == 2
    assert crf.main_text(df.limit(0), chain).count() == 0


def test_long_attributes_and_self_closed_elements():
    value = "x > y " * 5000
    page = (f'<div><p data-a="{value}">One</p><img src=\'{value}\'>two</div>'
            '<svg a="b"/><p>three</p><iframe src="u" /><p>four</p><svg><p>gone</p></svg>')
    assert [(b.text, b.path) for b in crf.blocks(page)] == [
        ("One", ("div", "p")), ("two", ("div",)), ("three", ("p",)), ("four", ("p",))]


@pytest.mark.parametrize("piece", ['<a b="', "<a b='\"", "<a ", "<b>x", "<div>x", "<", "<a x='>\"",
                                   "</p", "<div class=c><p>x", "<!-- ", "<svg>", "&"])
def test_broken_pages_of_a_megabyte(piece):
    began = time.time()
    crf.blocks(piece * (1_000_000 // len(piece)))
    crf.blocks(piece * (1_000_000 // len(piece)) + ">")
    assert time.time() - began < 20


def test_tag_ends_equal_a_scan_of_each_tag():
    """Where quotes are open or not, and none, one or both kinds are used."""
    draw = np.random.default_rng(5)
    tag = re.compile("""(?:[^>"']|"[^"]*+"|'[^']*+')*+>""")
    for _ in range(300):
        page = "".join(draw.choice(list("<>\"'ab "), 40))
        ends = crf.TagEnds(page)
        for place in draw.permutation(len(page)):
            expected = tag.match(page, place)
            assert ends.end(place) == (expected.end() - 1 if expected else -1)


def test_deep_elements_keep_their_text():
    page = "<div>a" * 2000 + "</div>b" * 2000 + "<p>c"
    assert "".join(b.text for b in crf.blocks(page)) == "a" * 2000 + "b" * 2000 + "c"
    assert crf.blocks(page)[-1].path == ("p",)


def test_pages_that_mark_no_article(spark):
    words = "some words of a paragraph that is long enough to be told from a menu entry. "
    pages = [(i, f"<html><body><nav><a>Home {i}</a></nav><div><p>{words * 2}{i}.</p><p>{words}{i}!"
              f"</p></div><footer>Copyright {i}</footer></body></html>") for i in range(30)]
    df = spark.createDataFrame(pages, "page_id long, html string")
    got = {r["page_id"]: r["text"] for r in crf.main_text(df, crf.fit(df)).collect()}
    assert got[3] == f"{words * 2}3. {words}3!"
    upper = df.withColumn("html", F.expr("replace(replace(html, '<div>', '<ARTICLE>'), '</div>', "
                                         "'</ARTICLE>')"))
    got = {r["page_id"]: r["text"] for r in crf.main_text(upper, crf.fit(upper)).collect()}
    assert got[3] == f"{words * 2}3. {words}3!"
    assert len(crf.sampled(upper.unionByName(upper), "page_id", "html", 7)) == 7


def test_viterbi_and_likelihood_agree_with_enumeration():
    page = [crf.Block(t, ("html", "body", "p"), frozenset()) for t in ("a b.", "c", "d e f.")]
    draw = np.random.default_rng(1)
    chain = crf.Chain(draw.normal(size=(crf.SIZE, 2)), draw.normal(size=(2, 2)))
    emit = chain.potentials(crf.features(page))

    def weight(y):
        return (sum(emit[i, v] for i, v in enumerate(y))
                + sum(chain.move[a, b] for a, b in zip(y, y[1:])))

    paths = [(a, b, c) for a in (0, 1) for b in (0, 1) for c in (0, 1)]
    assert tuple(map(int, chain.decode(page))) == max(paths, key=weight)
    belief, moves = np.empty((3, 2)), np.zeros((2, 2))
    crf._forward_backward(emit, chain.move, belief, moves)
    share = np.exp([weight(y) for y in paths])
    share /= share.sum()
    for i in range(3):
        assert np.isclose(belief[i, 1], sum(s for s, y in zip(share, paths) if y[i]))
    assert np.isclose(moves.sum(), 2)


def test_queries_equal_their_sql(spark, sf_dir):
    con, queries = connect(sf_dir), all_queries()
    for name, sql in all_oracles().items():
        assert differences(queries[name](spark, sf_dir).toPandas(), con.sql(sql).df()) == [], name


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r["doc_id"]: r["quality"]
              for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir).checkpoint()
        if number < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == corpus_pipeline.COLUMNS
            after = {r["doc_id"]: r["text"] for r in out.collect()}
            assert after.keys() <= before.keys() and len(after) == out.count(), name
            assert all(len(after[i]) <= len(before[i]) for i in after)
            if number == 0:
                wrong = [i for i in before if i in labels and (i in after) != (labels[i] == 1)]
                assert len(wrong) <= 0.03 * len(labels)
            before = after
        docs = out
    assert {r["doc_id"] for r in docs.collect()} == before.keys()
