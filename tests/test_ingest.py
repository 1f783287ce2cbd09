import json

import pandas as pd
import pytest

from tickerloom.plans.ingest import ingest, read_ingested, read_manifest, totals
from tickerloom.sources import sinks


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("in")
    out = tmp_path_factory.mktemp("out")

    def put(folder, name, data):
        target = root / folder
        target.mkdir(parents=True, exist_ok=True)
        mode = data if isinstance(data, bytes) else data.encode("utf-8")
        (target / name).write_bytes(mode)

    put("Sentiment Analysis for Financial News", "all-data.csv",
        "neutral,\"Café said \"\"ok\"\" &amp; more\"\npositive,It's up\npositive,It's up\n"
        .encode("latin1"))
    put("Sentiment Analysis for Financial News", "Sentences_50Agree.txt",
        "Profit rose@positive\nSales fell@negative\nSales fell@negative\n")
    put("Stock Market Prediction  India news headlines", "india-news-headlines.csv",
        "20010102,city,<b>Status</b> quo\n20010103,city,Fissures\nbad,city,x\n")
    put("Indian financial news articles 2003 to 2020", "news.csv",
        'Date,Title,Description\n"May 26, 2020, Tuesday",A b,d\n'
        '"May 27, 2020, Wednesday","two\nlines",\n')
    put("News_sentiments_india 2001 to 2022", "a.csv",
        "news,sentiment,text\nx,-1.0,good\ny,0.5,fine\nz,,fine\nz,,fine\n")
    put("Business News Headlines with Sentiment (2017-2021)", "b.csv",
        "date,headline,,label\n03-02-2021,One,,POSITIVE\n13-02-2021,Two,,very-bad\n"
        "13-02-2021,Two,,very-bad\n13-02-2021,Three,,nan\n13-02-2021,Three,,nan\n"
        "1,2,3,4,5\nshort\n")
    put("Prices/NIFTY 50", "ACME.csv", "Date,Close\n2021-01-01,10\n2021-01-02,11\n")
    put("Prices/NIFTY 50", "BETA.csv", "Date,Close\n2021-01-01,1.5\n2021-01-02,\n")
    put("misc", "training_data_26000.csv", "text,date\nA,2020-01-01\n")
    put("misc", "dump", "id|content\n1|Alpha\n2|Beta\n")
    put("misc", "rows.json", json.dumps([{"title": "T1", "created": "2020-01-01"},
                                        {"title": "T2", "created": "2020-01-02"}]))
    put("misc", "rows.jsonl", '{"title": "L1"}\n{"title": "L2"}\n')
    put("misc", "t.tsv", "title\tdate\nX\t01/02/2020\n")
    put("misc", "Readme.TXT", "no data")
    put("misc", "script.py", "pass")
    put("misc", "sheet.xlsx", "PK")
    put("misc", "broken.parquet", "not parquet")
    put("misc", "empty.csv", "")
    put("misc", "_marked.csv", "text\nx\n")
    put("misc/.cache", "kept.csv", "text\nx\n")
    put("misc", "emptied.parquet", "")
    pd.DataFrame({"Headline": ["P"], "when": pd.to_datetime(["2020-05-05 10:00"])}
                 ).to_parquet(root / "misc" / "p.parquet")
    put("melt", "mnews_2014.csv", "Date,h1,h2\n2014-01-01,One,\n2014-01-02,Two,Three\n")
    manifest = ingest(spark, str(root), str(out))
    rows = {r.input_file.rsplit("/", 1)[-1]: r for r in manifest.collect()}

    def data(name):
        frame = read_ingested(spark, str(out), rows[name].schema_group)
        return frame.where(frame.source_file == name).drop(
            "schema_group", "source_folder", "source_file").toPandas()

    return rows, data, manifest


def test_listing_skips_documents_and_scripts(run):
    rows, _, _ = run
    assert "Readme.TXT" not in rows and "script.py" not in rows


def test_one_bad_file_fails_alone(run):
    rows, _, manifest = run
    failed = {n for n, r in rows.items() if r.status == "failed"}
    assert failed == {"sheet.xlsx", "broken.parquet", "empty.csv", "emptied.parquet",
                      "_marked.csv", "kept.csv"}
    assert rows["p.parquet"].status == "success"
    total = totals(manifest).first()
    assert (total.total, total.failed) == (len(rows), 6)


def test_empty_and_hidden_files_say_why(run):
    rows, _, _ = run
    assert rows["empty.csv"].error == rows["emptied.parquet"].error == (
        "no columns to parse from an empty file")
    assert rows["_marked.csv"].error == rows["kept.csv"].error == "hidden files cannot be read"


def test_headerless_latin1_and_label_dedup(run):
    rows, data, _ = run
    got = data("all-data.csv").sort_values("text")
    assert got.to_dict("list") == {"sentiment": ["Neutral", "Positive"],
                                   "text": ['caf said "ok" & more', "it is up"]}
    assert (rows["all-data.csv"].rows_in, rows["all-data.csv"].rows_out) == (3, 2)


def test_at_separated(run):
    _, data, _ = run
    assert sorted(data("Sentences_50Agree.txt").sentiment) == ["Negative", "Positive"]


def test_exact_dates(run):
    rows, data, _ = run
    got = data("india-news-headlines.csv").sort_values("Headline")
    assert list(got.Headline) == ["fissures", "status quo", "x"]
    assert list(got.Date.fillna("-")) == ["2001-01-03 00:00:00", "2001-01-02 00:00:00", "-"]
    row = rows["india-news-headlines.csv"]
    assert (row.date_column, row.n_coerced, row.low_rate) == ("Date", 1, False)


def test_free_form_dates_and_quoted_newline(run):
    _, data, _ = run
    got = data("news.csv").sort_values("Date")
    assert list(got.Date) == ["2020-05-26 00:00:00", "2020-05-27 00:00:00"]
    assert list(got.Title) == ["a b", "two lines"]
    assert list(got.Description) == ["d", ""]


def test_numeric_sentiment_map_and_unlabelled_rows(run):
    _, data, _ = run
    got = data("a.csv")
    assert sorted(got.sentiment.fillna("-")) == ["-", "-", "0.5", "Negative"]


def test_day_first_drop_unnamed_long_and_short_rows(run):
    rows, data, _ = run
    got = data("b.csv")
    assert list(got.columns) == ["date", "headline", "sentiment"]
    assert sorted(got.headline) == ["", "one", "three", "three", "two"]
    assert set(got.date.dropna()) == {"2021-02-03 00:00:00", "2021-02-13 00:00:00"}
    assert set(got.sentiment.dropna()) == {"Positive", "Very-Bad"}


def test_symbol_from_file_name_and_types(run):
    _, data, _ = run
    acme, beta = data("ACME.csv"), data("BETA.csv")
    assert set(acme.Symbol) == {"ACME"} and set(beta.Symbol) == {"BETA"}
    assert acme.Close.dtype == "int64" and beta.Close.dtype == "float64"


def test_dates_skipped_where_the_rule_says_so(run):
    rows, data, _ = run
    assert rows["training_data_26000.csv"].date_column is None
    assert list(data("training_data_26000.csv").date) == ["2020-01-01"]


def test_sniffed_json_tsv_parquet_and_melt(run):
    _, data, _ = run
    assert sorted(data("dump").content) == ["alpha", "beta"]
    assert sorted(data("rows.json").created) == ["2020-01-01 00:00:00", "2020-01-02 00:00:00"]
    assert sorted(data("rows.jsonl").title) == ["l1", "l2"]
    assert list(data("t.tsv").date) == ["2020-01-02 00:00:00"]
    assert data("p.parquet").iloc[0].to_dict() == {"Headline": "p", "when": data("p.parquet").when[0]}
    assert sorted(data("mnews_2014.csv").text) == ["one", "three", "two"]


def test_a_failed_write_leaves_nothing_behind(spark, tmp_path, monkeypatch):
    root, out = tmp_path / "in", tmp_path / "out"
    root.mkdir()
    for name, body in [("a.csv", "text,v\nA,1\n"), ("b.csv", "text,v\nB,x\n"),
                       ("c.csv", "text,v\nC,2\n")]:
        (root / name).write_text(body)
    real, calls = sinks.write_parquet_tree, []

    def flaky(*args, **kwargs):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("disk went away")
        return real(*args, **kwargs)

    monkeypatch.setattr(sinks, "write_parquet_tree", flaky)
    manifest = ingest(spark, str(root), str(out)).collect()
    assert len(calls) > 2 and {r.status for r in manifest} == {"success"}
    for r in manifest:
        kept = read_ingested(spark, str(out), r.schema_group)
        assert kept.where(kept.source_file == r.input_file.rsplit("/", 1)[-1]).count() == r.rows_out
    (folder,) = (out / "runs").iterdir()
    folders = {p.name for p in folder.iterdir() if p.name.startswith("schema_group=")}
    assert folders == {f"schema_group={r.schema_group}" for r in manifest}
    assert sum(r.rows_out for r in manifest) == 3


def _texts(spark, out):
    """All published rows, as a reader of the output finds them."""
    groups = [r.schema_group for r in read_manifest(spark, out).where(
        "status = 'success'").select("schema_group").distinct().collect()]
    return sorted(r.text for g in groups for r in read_ingested(spark, out, g).collect())


def test_readers_see_the_old_or_the_new_output(spark, tmp_path, monkeypatch):
    """Also in the middle of a run, and after one that died between two writes."""
    first, second, out = tmp_path / "1", tmp_path / "2", str(tmp_path / "out")
    for root, names in ((first, "ab"), (second, "cd")):
        root.mkdir()
        for name in names:
            (root / f"{name}.csv").write_text(f"text,{name}\n{name},1\n")
    ingest(spark, str(first), out)
    real, seen = sinks.write_parquet_tree, []

    def watched(*args, **kwargs):
        real(*args, **kwargs)
        seen.append(_texts(spark, out))

    monkeypatch.setattr(sinks, "write_parquet_tree", watched)
    ingest(spark, str(second), out)
    assert seen == [["a", "b"], ["a", "b"]] and _texts(spark, out) == ["c", "d"]

    def dying(*args, **kwargs):
        real(*args, **kwargs)
        seen.append(1)
        if len(seen) == 4:
            raise KeyboardInterrupt

    monkeypatch.setattr(sinks, "write_parquet_tree", dying)
    with pytest.raises(KeyboardInterrupt):
        ingest(spark, str(first), out)
    assert len(seen) == 4 and _texts(spark, out) == ["c", "d"]
    monkeypatch.setattr(sinks, "write_parquet_tree", real)
    ingest(spark, str(first), out)
    assert _texts(spark, out) == ["a", "b"]
    ingest(spark, str(second), out)
    assert len(list((tmp_path / "out" / "runs").iterdir())) == 2  # the last and the one before


def test_a_run_without_readable_files_publishes_nothing_but_failures(spark, tmp_path):
    root, bad, out = tmp_path / "in", tmp_path / "bad", tmp_path / "out"
    root.mkdir()
    bad.mkdir()
    (root / "a.csv").write_text("text\nA\n")
    (bad / "b.parquet").write_text("not parquet")
    ingest(spark, str(root), str(out))
    assert _texts(spark, str(out)) == ["a"]
    (row,) = ingest(spark, str(bad), str(out)).collect()
    assert row.status == "failed"
    assert _texts(spark, str(out)) == []


def test_an_empty_root(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert ingest(spark, str(tmp_path / "in"), str(tmp_path / "out")).count() == 0


def test_many_small_files_stay_off_the_driver(spark, tmp_path, monkeypatch):
    """Two plans in one folder, one of them over folders that lie in each other."""
    root = tmp_path / "in"
    for folder in ("a", "a/b c", "d%2"):
        (root / folder).mkdir(parents=True)
        for i in range(400):
            (root / folder / f"f{i}.csv").write_text(f"text,n\nrow {i},{i}\n")
    for i in range(60):
        (root / "a" / f"g{i}.csv").write_text(f"title|n\nrow {i}|{i}\n")
        (root / "d%2" / f"h{i}.jsonl").write_text(json.dumps({"title": f"row {i}"}) + "\n")
    kind, collected = type(spark.range(0)), []
    real = kind.collect

    def counting(self):
        rows = real(self)
        collected.append(len(rows))
        return rows

    monkeypatch.setattr(kind, "collect", counting)
    manifest = ingest(spark, str(root), str(tmp_path / "out"))
    monkeypatch.setattr(kind, "collect", real)
    assert collected and max(collected) < 10
    total = totals(manifest).first()
    assert (total.total, total.success, total.rows_in, total.rows_out) == (1320, 1320, 1320, 1320)
    assert len(_texts_of(spark, str(tmp_path / "out"), "text")) == 1200


def _texts_of(spark, out, column):
    groups = [r.schema_group for r in read_manifest(spark, out).select(
        "schema_group").distinct().collect()]
    frames = [read_ingested(spark, out, g) for g in groups]
    return [r for f in frames if column in f.columns for r in f.select(column).collect()]


def test_long_ids_stay_exact_and_broken_json_lines_fail_their_file(spark, tmp_path):
    root, out = tmp_path / "in", tmp_path / "out"
    root.mkdir()
    (root / "ids.csv").write_text("text,code,big\nA,1234567890123456789,99999999999999999999\n"
                                  "A,1234567890123456788,99999999999999999998\n")
    (root / "good.jsonl").write_text('{"title": "x"}\n{"title": "y"}\n')
    (root / "bad.jsonl").write_text('{"title": "x"}\n{"title": \n')
    (root / "long.json").write_text(json.dumps([{"title": "t" * 50_000}]))
    rows = {r.input_file.rsplit("/", 1)[-1]: r for r in ingest(spark, str(root), str(out)).collect()}
    assert {n: r.status for n, r in rows.items()} == {
        "ids.csv": "success", "good.jsonl": "success", "bad.jsonl": "failed", "long.json": "success"}
    got = read_ingested(spark, str(out), rows["ids.csv"].schema_group).collect()
    assert sorted(r.code for r in got) == [1234567890123456788, 1234567890123456789]
    assert sorted(r.big for r in got) == ["99999999999999999998", "99999999999999999999"]
