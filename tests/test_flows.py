import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tickerloom.operators import chat, tokens
from tickerloom.plans import alpha_news as N
from tickerloom.plans.chat_set import LabellingStopped, LABELLED_SCHEMA, chat_training_set
from tickerloom.plans.token_set import token_dataset
from tickerloom.sources import dims, readers, sinks
from tickerloom.sources.contracts import news_table, prices_table
from tickerloom.streaming.incremental import arriving_json, incremental_label


def good(prompts):
    return "Sentiment: Neutral\nLength: " + prompts.str.len().astype(str) + "\nDecision: HOLD"


def labeller(df):
    return chat.label_batches(df, good)


@pytest.mark.parametrize("n", [0, 1, 1024, 1025, 2048])
def test_chunk_sizes(spark, n):
    df = spark.createDataFrame([(1, list(range(n)))], "id int, input_ids array<int>")
    chunks = tokens.chunk_ids(df).orderBy("chunk_no").collect()
    assert [i for c in chunks for i in c.input_ids] == list(range(n))
    assert [len(c.input_ids) for c in chunks] == [1024] * (n // 1024) + ([n % 1024] if n % 1024 else [])


def test_token_dataset_and_padding(spark):
    chats = spark.createDataFrame(
        [(i, [("user", "w " * (i * 3)), ("assistant", "Ünï, ok!")]) for i in range(6)],
        "id int, messages array<struct<role:string,content:string>>")
    rows = token_dataset(chats, ["id"], max_length=8)
    got = rows.orderBy("id", "chunk_no").collect()
    text = chat.render_chat(F.col("messages"))
    sizes = {r.id: r.n for r in chats.select("id", F.size(tokens.tokens_of(text)).alias("n")).collect()}
    for i in range(6):
        mine = [r for r in got if r.id == i]
        assert sum(len(r.input_ids) for r in mine) == sizes[i]
        assert all(len(r.input_ids) == 8 for r in mine[:-1])
    assert all(r.attention_mask == [1] * len(r.input_ids) for r in got)
    padded = tokens.pad_batches(rows.drop("attention_mask"), ["id", "chunk_no"]).orderBy(
        "id", "chunk_no").collect()
    for index, (p, r) in enumerate(zip(padded, got)):
        longest = max(len(x.input_ids) for x in got[index // 4 * 4: index // 4 * 4 + 4])
        gap = longest - len(r.input_ids)
        assert p.batch_id == index // 4
        assert p.input_ids == r.input_ids + [0] * gap
        assert p.attention_mask == [1] * len(r.input_ids) + [0] * gap
        assert p.labels == r.input_ids + [-100] * gap


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_frequent_and_rare_tokens_get_one_id_each(spark, monkeypatch, limit):
    monkeypatch.setattr(tokens, "FREQUENT", 2)
    monkeypatch.setattr(tokens, "BROADCAST_BYTES", limit)
    df = spark.createDataFrame([(1, "a b a c " + "d" * 100), (2, "b a , x")], "id int, t string")
    rows = tokens.token_rows(df, ["id"], "t")
    vocab = tokens.vocabulary(rows)
    ids = {r.token: r.token_id for r in vocab.collect()}
    assert ids["a"] == 0 and ids["b"] == 1 and sorted(ids.values()) == list(range(6))
    got = {(r.id, r.pos): (r.token, r.token_id) for r in tokens.with_ids(rows, vocab).collect()}
    assert len(got) == 9 and all(ids[t] == i for t, i in got.values())
    known = tokens.with_ids(rows, vocab.where("token in ('a', 'b')")).collect()
    assert len(known) == 9
    assert all(r.token_id == ids[r.token] if r.token in "ab" else r.token_id == tokens.UNKNOWN_ID
               for r in known)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_texts_encode_as_token_rows_do(spark, monkeypatch, limit):
    monkeypatch.setattr(tokens, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(tokens, "LOOKED_UP", 2)
    df = spark.createDataFrame(
        [(1, "a b a c d e"), (2, "b, x"), (3, None), (4, ""), (5, " "), (6, "b, x")],
        "id int, t string")
    rows = tokens.token_rows(df, ["id"], "t")
    for vocab in [(all_of := tokens.vocabulary(rows)), all_of.where("token <> 'a'"),
                  all_of.where("false")]:
        def listed(chunks):
            return [tuple(r) for r in chunks.orderBy("id", "chunk_no").collect()]

        got = listed(tokens.encode_texts(df, vocab, ["id"], "t", max_length=4))
        assert got == listed(tokens.encode_chunks(rows, vocab, ["id"], max_length=4))
        assert [(r[0], r[1], len(r[2])) for r in got] == [
            (1, 0, 4), (1, 1, 2), (2, 0, 3), (6, 0, 3)]


def test_prompt_and_render(spark):
    df = spark.createDataFrame([("x" * 15001, "out")], "input string, output string")
    prompt = chat.build_prompts(df).first().messages
    assert prompt[0].content == chat.SYSTEM_PROMPT
    assert prompt[1].content == "Analyze this text:\n\n" + "x" * 15001
    cut = chat.build_prompts(df, max_chars=15000).first().messages
    assert cut[1].content == "Analyze this text:\n\n" + "x" * 15000
    text = chat.to_chat_messages(df).select(chat.render_chat(F.col("messages"))).first()[0]
    assert text.startswith("<|im_start|>system\nYou are") and text.endswith(
        "<|im_start|>assistant\nout<|im_end|>\n")


def write_lines(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))


def test_labelling_resumes_and_skips(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "a.jsonl", [
        {"input": "one", "src": "s"}, {"input": "  "}, {"other": 1}, "{broken", {"input": "two"},
        {"input": "two"}, {"input": "héllo ₹"}])
    paths = [str(source), str(tmp_path / "labelled"), str(tmp_path / "chat")]
    first = chat_training_set(spark, *paths, labeller, "input string, src string").first()
    assert (first.newly_labelled, first.chat_records) == (4, 4)
    second = chat_training_set(spark, *paths, labeller, "input string, src string").first()
    assert (second.newly_labelled, second.chat_records) == (0, 4)
    write_lines(source, "b.jsonl", [{"input": "three"}, {"input": "one"}])
    third = chat_training_set(spark, *paths, labeller, "input string, src string").first()
    assert (third.newly_labelled, third.chat_records) == (1, 5)
    chats = readers.read_chat_dataset(spark, paths[2]).collect()
    assert {m.messages[1].content for m in chats} == {"one", "two", "héllo ₹", "three"}


def test_malformed_responses_are_dropped(spark):
    df = spark.createDataFrame([("a",), ("b",)], "input string")
    responses = spark.createDataFrame([("a", "Sentiment: x"), ("b", "Sentiment: x Decision: y")],
                                      "input string, output string")
    assert [r.input for r in chat.label_from_table(df, responses).collect()] == ["b"]


def test_streaming_labelling(spark, tmp_path):
    source, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "p")
    write_lines(source, "a.jsonl", [{"input": "one"}, {"input": ""}, {"input": "two"}])
    for _ in range(2):
        incremental_label(spark, arriving_json(spark, str(source), "input string"), out,
                          progress, labeller).awaitTermination()
    write_lines(source, "b.jsonl", [{"input": "two"}, {"input": "three"}])
    for place in (progress, str(tmp_path / "lost")):  # a lost checkpoint replays everything
        incremental_label(spark, arriving_json(spark, str(source), "input string"), out,
                          place, labeller).awaitTermination()
    got = readers.read_jsonl_lenient(spark, out, LABELLED_SCHEMA).collect()
    assert sorted(r.input for r in got) == ["one", "three", "two"]


def news_inputs(spark):
    long = "Infosys profit " + "x" * 400
    rows = [
        (1, "u1", "Mon, 04 Jan 2021 10:00:00 GMT", "Infosys earnings beat", "d", ("Pub",), long),
        (2, "u1", "Tue, 05 Jan 2021 10:00:00 GMT", "Infosys profit", "d", ("Pub",), long),
        (3, "u2", "not a date", "Infosys profit", "d", ("Pub",), long),
        (4, "", "Mon, 04 Jan 2021 10:00:00 GMT", "Infosys profit", "d", ("Pub",), long),
        (5, "u3", "Mon, 04 Jan 2021 10:00:00 GMT", "Infosys profit", "a summary of some length here",
         (None,), None),
        (6, "u4", "Mon, 04 Jan 2021 10:00:00 GMT", "Infosys loss", "d", ("P",), None),
        (7, "u5", "Mon, 04 Jan 2031 10:00:00 GMT", "Infosys loss", "d", ("P",), long),
    ]
    raw = spark.createDataFrame(rows, "doc_id long, url string, published string, title string, "
                                      "description string, publisher struct<title:string>, full_text string")
    days = [dt.datetime(2021, 1, 4) + dt.timedelta(days=i, hours=9) for i in range(20)]
    quotes = spark.createDataFrame(
        [("INFY.NS", d, float(10 + i)) for i, d in enumerate(days)]
        + [("INFY.NS", days[0], None), ("^NSEI", days[3], None)]
        + [("^NSEI", d, 5.0) for d in days], "ticker string, ts timestamp, close double")
    prices = prices_table(quotes)
    return (news_table(raw), prices.where("ticker <> '^NSEI'"),
            prices.where("ticker = '^NSEI'"), dims.ticker_dim(spark), dims.keyword_dim(spark))


def test_news_records(spark):
    records = N.alpha_news(*news_inputs(spark)).collect()
    got = {(r.ticker, r.published_date, r.news_text[:20], r.true_alpha) for r in records}
    # u1: the newest result for "profit" comes later than the one for "earnings".
    assert got == {("INFY.NS", "2021-01-04", "Infosys profit xxxxx", 1),
                   ("INFY.NS", "2021-01-04", "Infosys profit | Unk", 1)}
    assert {r.company_name for r in records} == {"Infosys"}
    assert N.to_labelling_input(N.alpha_news(*news_inputs(spark))).columns[3] == "input"


def test_saved_counts_report_zeros(spark):
    inputs = news_inputs(spark)
    counts = N.saved_counts(N.alpha_news(*inputs), inputs[3], len(dims.KEYWORDS))
    assert counts.count() == 1000
    assert counts.agg(F.sum("saved")).first()[0] == 2


def test_news_resume(spark, tmp_path):
    records, progress = str(tmp_path / "records"), str(tmp_path / "progress")
    sinks.append_checkpoint(spark.createDataFrame([(" TCS.NS ",)], "ticker string"), progress)
    done = N.incremental_news(spark, *news_inputs(spark), records, progress)
    assert len(readers.read_checkpoint(spark, progress).collect()) == 50
    again = N.incremental_news(spark, *news_inputs(spark), records, progress)
    assert spark.read.json(records).count() == 2
    # The progress was lost, the records were not: nothing is written twice.
    N.incremental_news(spark, *news_inputs(spark), records, str(tmp_path / "lost"))
    assert spark.read.json(records).count() == 2


class Died(Exception):
    pass


def test_news_run_that_dies_is_repeated(spark, tmp_path):
    """Between records and log, and again between log and the end."""
    records, progress = str(tmp_path / "records"), str(tmp_path / "progress")

    def die():
        raise Died

    for _ in range(2):
        with pytest.raises(Died):
            N.incremental_news(spark, *news_inputs(spark), records, progress, die)
        assert spark.read.json(records).count() == 2
        assert readers.read_checkpoint(spark, progress).count() == 0
    assert N.incremental_news(spark, *news_inputs(spark), records, progress).count() == 50
    assert spark.read.json(records).count() == 2
    assert N.incremental_news(spark, *news_inputs(spark), records, progress).count() == 0


def test_a_failing_labeller_keeps_earlier_batches(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "a.jsonl", [{"input": f"text {i}"} for i in range(40)])
    paths = [str(source), str(tmp_path / "labelled"), str(tmp_path / "chat")]
    calls = []

    def failing(df):
        calls.append(df.count())
        if len(calls) == 3:
            raise Died
        return labeller(df)

    with pytest.raises(LabellingStopped) as stopped:
        chat_training_set(spark, *paths, failing, batch_rows=10)
    kept = sum(calls[:2])
    assert stopped.value.newly_labelled == stopped.value.chat_records == kept and 0 < kept < 40
    assert readers.read_chat_dataset(spark, paths[2]).count() == kept
    rest = chat_training_set(spark, *paths, labeller, batch_rows=10).first()
    assert (rest.newly_labelled, rest.chat_records) == (40 - kept, 40)


def test_a_run_without_its_log_is_logged_again(spark, tmp_path):
    import shutil

    source = tmp_path / "in"
    write_lines(source, "a.jsonl", [{"input": "one"}, {"input": "two"}])
    paths = [str(source), str(tmp_path / "labelled"), str(tmp_path / "chat")]
    chat_training_set(spark, *paths, labeller)
    shutil.rmtree(tmp_path / "labelled" / "_log")
    again = chat_training_set(spark, *paths, labeller).first()
    assert (again.newly_labelled, again.chat_records) == (0, 2)


def test_a_stream_does_not_read_its_old_records(spark, tmp_path):
    """Rows read by a run: its inputs and the records of the run before."""
    source, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "p")
    read = []
    for run in range(4):
        write_lines(source, f"{run}.jsonl", [{"input": f"{run} {i}"} for i in range(5)]
                    + [{"input": "0 0"}, {"input": f"bad {run}"}])
        query = incremental_label(spark, arriving_json(spark, str(source), "input string"), out,
                                  progress, lambda df: df.withColumn("output", F.when(
                                      ~F.col("input").startswith("bad"),
                                      "Sentiment: Neutral Decision: HOLD")))
        query.awaitTermination()
        read.append(sum(p["numInputRows"] for p in query.recentProgress))
    got = readers.read_jsonl_lenient(spark, out, LABELLED_SCHEMA).collect()
    # "0 0" twice in the first run, as copies in one run all stay.
    assert sorted(r.input for r in got) == sorted(
        [f"{run} {i}" for run in range(4) for i in range(5)] + ["0 0"])
    assert read[1] == 7 + 6 and read[2] == read[3] == 7 + 5
