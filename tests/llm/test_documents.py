"""Quality rules, sharding, the classifier, near duplicates and passages."""

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tickerloom.llm import gam, minhash, passages, quality_rules, sharding
from tickerloom.llm import shingles as sh
from tickerloom.llm.components import components
from tests.oracle import differences

DDL = "doc_id long, text string, source string, n_words string, __row long, component string"


def prose(chance, n, size=3000):
    return " ".join(f"w{chance.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty texts, one word, repeated rows, equal texts, clashing columns."""
    rows = [(1, None, "a"), (2, "", "a"), (3, "one", None), (4, "Five words are in here", "a"),
            (4, "Five words are in here", "a"), (5, "five WORDS are in here", "b"),
            (None, "no id at all", "a"), (6, "x " * 30000, "a"), (7, " \n\t \n", "a")]
    return spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], DDL)


# ---------------------------------------------------------------- quality rules

def base_by_hand(text):
    words = (text or "").encode().split()
    windows = Counter(zip(words, words[1:], words[2:]))
    places = {p for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1
              for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (len(words), sum(len(w.decode()) for w in words),
            sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(places),
            len(words) < 50 or 100 * len(places) > 50 * len(words))


def test_base_rules(spark, odd):
    chance = random.Random(2)
    texts = [prose(chance, n, size) for n, size in ((60, 5), (60, 9), (200, 30), (500, 3000))]
    texts += ["a\nb\na\n\nb c\n", "é|ü# <>&* $%", "a b c a b c", "a b c d\x0bb c d"]
    more = spark.createDataFrame([(100 + i, t, "a", "", 0, "") for i, t in enumerate(texts)], DDL)
    rows = quality_rules.quality_rules(odd.unionByName(more)).collect()
    assert len(rows) == odd.count() + len(texts)
    expected = defaultdict(list)
    for r in odd.unionByName(more).collect():
        expected[r["doc_id"]].append(base_by_hand(r["text"]))
    for r in rows:
        assert tuple(r[c] for c in quality_rules.RESULTS[:6]) in expected[r["doc_id"]]
        assert r["component"] == ("clash" if (r["doc_id"] or 0) < 100 else "")


def test_frequent_lines_go_but_copies_stay(spark):
    """Exact copies are one document; near copies are, where the caller says so."""
    chance = random.Random(5)
    menu = "Home   About Contact"
    rows = [(i, f"{menu}\n{prose(chance, 80)}\n{prose(chance, 80)}", "a", i) for i in range(30)]
    story = f"{prose(chance, 90)}\n{prose(chance, 90)}"
    rows += [(100 + i, story, "a", 100) for i in range(40)]  # copies
    near = [(200 + i, f"{story}\nedit number {i}", "a", 100) for i in range(40)]
    junk = "\n".join([menu] * 30)
    rows += [(300, junk + "\n" + prose(chance, 20), "a", 300),
             (301, f"{menu}\n{prose(chance, 60)}", "b", 301)]
    ddl = "doc_id long, text string, source string, family long"
    docs, both = (spark.createDataFrame(r, ddl) for r in (rows, rows + near))
    for frame, identity in ((docs, None), (docs, "family"), (both, "family")):
        got = {r["doc_id"]: r for r in quality_rules.quality_rules(frame, identity=identity).collect()}
        assert all(got[i]["n_removed_words"] == 3 and got[i]["kept"] for i in range(30))
        copies = [r for i, r in got.items() if 100 <= i < 300]
        assert all(r["n_removed_words"] == 0 and r["kept"] for r in copies)
        assert not got[300]["kept"] and got[301]["n_removed_words"] == 0
        clean = {r["doc_id"]: r["text"] for r in
                 quality_rules.kept_documents(frame, identity=identity).collect()}
        assert clean.keys() == {i for i, r in got.items() if r["kept"]}
        assert menu not in clean[0] and clean[100] == story and menu in clean[301]
    got = quality_rules.quality_rules(both).where("doc_id between 100 and 299").collect()
    assert not any(r["kept"] for r in got)  # 41 distinct documents hold each line


@pytest.mark.parametrize("shared,own", [(1, 10), (2, 15), (3, 15), (2, 400)])
def test_depleted_documents_are_rejected(spark, shared, own, tmp_path):
    """600 documents on 10 hosts, each with the host's lines and words of its own."""
    chance = random.Random(shared * 100 + own)
    rows = []
    for host in range(10):
        lines = [prose(chance, 40, 10**6) for _ in range(shared)]
        rows += [(60 * host + i, "\n".join([*lines, prose(chance, own, 10**6)]), f"h{host}")
                 for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = quality_rules.quality_rules(docs, keep=["doc_id"])
    found = got.collect()
    assert {r["n_removed_words"] for r in found} == {40 * shared}
    assert {r["kept"] for r in found} == {own == 400}
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert differences(got.toPandas(), con.sql(
        quality_rules.ORACLES["op1_quality_rules"]).df()) == []


def test_several_frequent_lines_of_a_host_go(spark):
    chance = random.Random(6)
    rows = []
    for host in range(12):  # the notice is the lowest line at most of the hosts
        notice, menu = prose(chance, 60, 10**6), prose(chance, 10, 10**6)
        for i in range(40):
            own = [prose(chance, 10, 10**6) for _ in range(5)]
            rows.append((40 * host + i, "\n".join([menu, *own, notice]), f"h{host}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = quality_rules.quality_rules(docs).collect()
    assert {r["n_removed_words"] for r in got} == {70}


def test_quality_rules_of_an_empty_table(odd):
    assert quality_rules.quality_rules(odd.limit(0)).count() == 0
    assert quality_rules.kept_documents(odd).count() == 0


# --------------------------------------------------------------------- sharding

def smallest(sizes, shards):
    def need(cap):
        n, load = 1, 0
        for s in sizes:
            n, load = (n, load + s) if load + s <= cap else (n + 1, s)
        return n
    return next(c for c in range(max(sizes), sum(sizes) + 1) if need(c) <= shards)


@pytest.mark.parametrize("seed,shards", [(0, 1), (1, 3), (2, 7), (3, 24)])
def test_cut_cells_is_minimax(spark, seed, shards):
    chance = random.Random(seed)
    sizes = [chance.choice([1, 2, 3, 9, 40]) for _ in range(60)]
    cells = [(3 * i, s, 1) for i, s in enumerate(sizes)]
    table = spark.createDataFrame(cells, "cell long, size long, n long")
    firsts = sharding.cut_cells(table, shards).first()["firsts"]
    assert len(firsts) <= shards
    loads = [0] * len(firsts)
    for cell, size, _ in cells:
        loads[sum(f <= cell for f in firsts) - 1] += size
    assert max(loads) == smallest(sizes, shards) and min(loads) > 0


def test_shards(spark, odd):
    chance = random.Random(8)
    more = spark.createDataFrame(
        [(1000 + i, prose(chance, chance.randrange(1, 60)), "a", "", 0, "") for i in range(1500)]
        + [(9000 + i, "the same text", "a", "", 0, "") for i in range(300)], DDL)
    docs = odd.where("doc_id <> 6 or doc_id is null").unionByName(more)
    rows = sharding.shard_by_bytes(docs).collect()
    assert len(rows) == docs.count() and {r["law"] for r in rows} == {"bytes"}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    slots, loads, homes = defaultdict(list), Counter(), defaultdict(set)
    for r in rows:
        text = texts[r["doc_id"]].encode()
        assert r["size"] == len(text) + 8 and r["text_crc32"] == zlib.crc32(text)
        assert r["grown_shard"] is None and 0 <= r["shard"] < 24
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
        homes[text].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())
    assert max(loads.values()) < 1.5 * sum(loads.values()) / 24
    assert sharding.shard_by_bytes(docs.limit(0)).count() == 0


# ------------------------------------------------------------------- classifier

def test_classifier_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    scored = gam.score(docs, gam.train(docs, labels), keep=["doc_id"]).collect()
    held = [(r["score"] >= 0.5) == (truth[r["doc_id"]] == 1) for r in scored
            if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert len(scored) == docs.count() and np.mean(held) > 0.97


def test_interactions_are_learnt():
    draw = np.random.default_rng(0)
    x = np.zeros((3000, len(gam.NAMES)))
    x[:, :2] = draw.random((3000, 2))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)  # no feature tells alone
    model = gam.fit(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) >= 0.5) == (y[2000:] == 1)).mean() > 0.9


def test_classifier_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    for some in (labels, labels.limit(0)):
        model = gam.train(odd, some)
        rows = gam.score(odd, model).collect()
        assert len(rows) == odd.count() and all(r["score"] == 0.5 for r in rows)
    assert gam.kept_documents(odd, labels).columns == odd.columns
    assert gam.score(odd.limit(0), gam.Model()).count() == 0


# -------------------------------------------------------------- near duplicates

def edited(chance, text, n):
    words = text.split(" ")
    for _ in range(n):
        words[chance.randrange(len(words))] = f"e{chance.randrange(10**6)}"
    return " ".join(words)


def brute_components(texts, k, percent):
    sets = {i: set(sh.shingle_hashes(sh.WordHashes()(sh.words_of(t or "")), k).tolist())
            for i, t in texts.items()}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def test_near_duplicates_equal_brute_force(spark):
    chance = random.Random(11)
    texts = {}
    for _ in range(6):
        base = prose(chance, chance.randrange(20, 200))
        for _ in range(chance.randrange(1, 40)):
            texts[len(texts)] = edited(chance, base, chance.randrange(0, 9))
    texts.update({500: None, 501: "", 502: "two words", 503: "Two WORDS", 504: "two words more"})
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()],
                                 "doc_id long, text string, component_id int")
    rows = minhash.near_duplicates(docs, k=4).collect()
    expected, sizes = brute_components(texts, 4, 80)
    assert {r["doc_id"]: r["component_id"] for r in rows} == expected
    assert all(r["n_shingles"] == sizes[r["doc_id"]] for r in rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_near_duplicates_of_odd_rows(odd):
    rows = minhash.near_duplicates(odd, k=4).collect()
    assert len(rows) == odd.count()
    got = {r["doc_id"]: r["component_id"] for r in rows}
    assert got[4] == 4 and got[5] == 4 and got[None] is None and got[1] == 1 and got[2] == 2
    assert minhash.near_duplicates(odd.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 91)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 91: 90}


# --------------------------------------------------------------------- passages

def test_windows_hold_every_long_stretch_once():
    draw = np.random.default_rng(4)
    for values in (draw.integers(0, 2**63, 90, dtype=np.uint64), np.zeros(70, np.uint64)):
        n, width = len(values), 9
        l, c, r = passages.compact_windows(values, np.array([0]), np.array([n]), width)
        for i in range(n):
            for j in range(i + width, n + 1):
                inside = np.flatnonzero((l <= i) & (i <= c) & (c < j) & (j - 1 <= r))
                assert len(inside) == 1
                assert values[c[inside[0]]] >> np.uint64(24) == values[i:j].min() >> np.uint64(24)


def test_planted_passages_are_found_and_clean_documents_left(spark):
    chance = random.Random(17)
    shared = [prose(chance, n) for n in (51, 60, 200)]
    texts = {i: f"{prose(chance, 70)} {shared[i % 3]} {prose(chance, 90)}" for i in range(45)}
    texts.update({100 + i: prose(chance, 200) for i in range(20)})
    near = prose(chance, 150)
    texts[200], texts[201] = f"{prose(chance, 40)} {near}", f"{edited(chance, near, 2)} tail"
    texts[300] = texts[301] = prose(chance, 80)
    texts.update({400: None, 401: "", 402: "a " * 9000, 403: shared[0]})
    docs = spark.createDataFrame([(i, t, 0) for i, t in texts.items()] + [(None, shared[1], 0)],
                                 "doc_id long, text string, start int")
    rows = passages.repeated_passages(docs).collect()
    hit = defaultdict(set)
    for r in rows:
        assert r["source"] < r["id"] and r["n_words"] >= 50
        hit[r["id"]].update(range(r["start"], r["start"] + r["n_words"]))
    for i in range(3, 45):
        assert set(range(70, 70 + len(shared[i % 3].split()))) <= hit[i]
    assert {201, 301, 403} <= hit.keys() and len(hit[301]) == 80
    assert not hit.keys() & {0, 1, 2, 200, 300, 402, *range(100, 120)}
    cut = passages.without_passages(docs.where("doc_id is not null"),
                                    passages.repeated_passages(docs).checkpoint())
    left = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert 301 not in left and 403 not in left and left[100] == texts[100] and left[400] is None
    assert shared[0] in left[0] and shared[0] not in left[3] and len(left[3].split()) == 160


def test_passages_of_an_empty_table(odd):
    assert passages.repeated_passages(odd.limit(0)).count() == 0


def test_exact_passages_behind_a_frequent_line_equal_brute_force(spark):
    chance = random.Random(23)
    line = prose(chance, 30)
    rows = [(i, f"{line} {prose(chance, 60)}") for i in range(40)]  # earlier holders of the line
    for n in range(25):
        passage = f"{line} {prose(chance, 30)}"
        rows += [(100 + 2 * n + k, f"{prose(chance, 40)} {passage} {prose(chance, 40)}")
                 for k in (0, 1)]
    rows = passages.repeated_passages(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()
    hit = defaultdict(set)
    for r in rows:
        hit[r["id"], r["source"]].update(range(r["start"], r["start"] + r["n_words"]))
    assert hit.keys() == {(101 + 2 * n, 100 + 2 * n) for n in range(25)}
    assert all(set(range(40, 100)) <= words for words in hit.values())


def hits_of(spark, rows):
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    hit = defaultdict(set)
    for r in found.collect():
        hit[r["id"]].update(range(r["start"], r["start"] + r["n_words"]))
    return hit


def test_near_passages_of_frequent_lines_are_found(spark):
    """Two lines, each held by an earlier document, with one word between in the second copy."""
    chance = random.Random(29)
    rows = []
    for n in range(20):
        one, two = prose(chance, 30, 10**6), prose(chance, 30, 10**6)
        rows += [(1000 * k + n, f"{prose(chance, 60, 10**6)} {text} {prose(chance, 60, 10**6)}")
                 for k, text in enumerate((one, two, f"{one} {two}", f"{one} extra {two}"))]
    hit = hits_of(spark, rows)
    assert hit.keys() == {3000 + n for n in range(20)}
    assert all(set(range(60, 121)) <= hit[3000 + n] for n in range(20))


def test_near_passages_in_a_crowd_equal_brute_force(spark):
    """Passages of frequent lines with edits; all pairs of documents by brute force."""
    chance = random.Random(31)
    lines = [prose(chance, 24, 10**6) for _ in range(12)]
    rows = []
    for i in range(120):  # holders of single lines
        rows.append((i, f"{prose(chance, 40, 10**6)} {chance.choice(lines)} {prose(chance, 40, 10**6)}"))
    for n in range(40):
        some = chance.sample(lines, 3)
        for k in (0, 1):
            text = " ".join(some) if not k else edited(chance, " ".join(some), 1 + n % 3)
            rows.append((1000 + 2 * n + k,
                         f"{prose(chance, 40, 10**6)} {text} {prose(chance, 40, 10**6)}"))
    hit = hits_of(spark, rows)
    width = 46
    tokens = {i: sh.shingle_hashes(sh.WordHashes()(sh.words_of(t)), 5).astype(np.uint32)
              for i, t in rows}
    expected = set()
    for j in tokens:
        for i in tokens:
            if i < j and passages.shared(tokens[j], passages.Hub(tokens[i]), width, 0.8):
                expected.add(j)
    assert len(expected) > 30
    assert hit.keys() <= expected
    assert len(hit.keys() & expected) >= 0.95 * len(expected)


def covered_by_brute_force(rows):
    """Words of each document in a passage that some earlier one has, all pairs compared."""
    tokens = {i: sh.shingle_hashes(sh.WordHashes()(sh.words_of(t)), 5).astype(np.uint32)
              for i, t in rows}
    hit = defaultdict(set)
    for j in tokens:
        for i in tokens:
            if i < j:
                for a, b, _, _ in passages.shared(tokens[j], passages.Hub(tokens[i]), 46, 0.8):
                    hit[j].update(range(a, b + 4))
    return hit


def test_near_passages_behind_one_seed_equal_brute_force(spark):
    """The one stretch in common is a line that more earlier documents hold than meet at once."""
    chance = random.Random(41)

    def words(n):
        return prose(chance, n, 10**6)

    line = words(30)
    rows = [(i, f"{words(40)} {line} {words(40)}") for i in range(2 * passages.HEADS + 10)]
    for n in range(20):
        tail = words(22)
        rows += [(1000 + 2 * n + k, f"{words(40)} {line} {words(1)} {tail} {words(40)}")
                 for k in (0, 1)]
    for n in range(20):  # the second of three is covered there by the first, but not by the third
        head, tail = words(22), words(40)
        rows += [(2000 + 3 * n, f"{words(40)} {line} {tail} {words(40)}"),
                 (2001 + 3 * n, f"{words(40)} {head} {words(1)} {line} {tail} {words(40)}"),
                 (2002 + 3 * n, f"{words(40)} {head} {words(1)} {line} {words(40)}")]
    expected = covered_by_brute_force(rows)
    assert {1001 + 2 * n for n in range(20)} <= expected.keys()
    assert {2002 + 3 * n for n in range(20)} <= expected.keys()
    assert hits_of(spark, rows) == expected


def test_spans_of_grams_equal_brute_force():
    draw = np.random.default_rng(43)
    for width in (46, 37, 12):
        for _ in range(20):
            within = np.zeros(160, bool)
            for _ in range(draw.integers(1, 7)):
                a = draw.integers(0, 130)
                within[a:a + draw.integers(4, 30)] = True
            at = np.flatnonzero(np.lib.stride_tricks.sliding_window_view(within, 4).all(1))
            place = draw.choice(150, 8, replace=False)
            score = np.concatenate([[0], np.cumsum(np.where(within, 1, -4))])
            expected = [any(score[j] >= score[i] and within[i] and within[j - 1]
                            for i in range(p + 1)
                            for j in range(max(p + 10, i + width), 161)) for p in place]
            assert passages.spanned(at, place, 10, width, 0.8).tolist() == expected
    assert not passages.spanned(np.zeros(0, np.int64), np.array([3]), 10, 46, 0.8).any()


def test_one_row_per_maximal_passage(spark):
    chance = random.Random(37)
    a, b = prose(chance, 60, 10**6), prose(chance, 60, 10**6)
    rows = [(3, f"{a} {b}"), (1, a), (2, f"{a} {b}"), (4, f"x {a} {b} y"), (5, b)]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((r["id"], r["start"], r["n_words"], r["source"]) for r in found.collect())
    assert got == [(2, 0, 60, 1), (3, 0, 120, 2), (4, 1, 120, 2), (5, 0, 60, 2)]


def changed(chance, text, every, how):
    words = text.split()
    for i in range(len(words) - len(words) % every - every // 2, 0, -every):
        words[i:i + (how == "delete")] = [] if how == "delete" else [f"new{chance.randrange(10**6)}"]
    return " ".join(words)


def test_passages_with_insertions_and_deletions(spark):
    chance = random.Random(29)
    rows, i = [], 0
    for how in ("insert", "delete"):
        for n, every in ((90, 90), (200, 45), (52, 52)):
            for _ in range(8):
                text = prose(chance, n, 10**6)
                rows += [(i, f"{prose(chance, 60, 10**6)} {text} {prose(chance, 30, 10**6)}"),
                         (i + 1, f"{prose(chance, 20, 10**6)} {changed(chance, text, every, how)} "
                                 f"{prose(chance, 70, 10**6)}")]
                i += 2
    inner = prose(chance, 60, 10**6)  # its seeds stand at three places of the earlier text
    part = " ".join(inner.split()[20:40])
    rows += [(i, f"{part} {prose(chance, 30, 10**6)} {inner} {prose(chance, 30, 10**6)} {part}"),
             (i + 1, f"{inner} {prose(chance, 50, 10**6)}")]
    found = passages.repeated_passages(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["id"], r["source"]) for r in found} == {(k + 1, k) for k in range(0, i + 1, 2)}
