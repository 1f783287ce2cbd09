"""Whitening, exact duplicates and the prefix trie against brute force."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerloom.llm import fingerprints as fp
from tickerloom.llm import prefix_trie as pt
from tickerloom.llm import whitening as wh


# -- whitening -----------------------------------------------------------------

def vectors(kind):
    draw = np.random.default_rng(7)
    v = draw.normal(size=(400, 6)) * [9, 5, 3, 1, 0.5, 0.3]
    if kind == "hot":
        v[50:350] = v[50]
    if kind == "flat":
        v[:, 2] = 4
        v[:, 5] = v[:, 0]
    if kind == "far":
        v = v * 1e9 + 1e12
    return v @ np.linalg.qr(draw.normal(size=(6, 6)))[0] if kind == "mixed" else v


def framed(spark, v):
    rows = [(i, [float(x) for x in one], "x") for i, one in enumerate(v)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, whitened string")


@pytest.mark.parametrize("kind", ["mixed", "hot", "flat", "far"])
def test_whitening_equals_eigenvectors(spark, kind):
    v = vectors(kind)
    got = wh.whitened(framed(spark, v)).toPandas()
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in one] for one in v], object)
    sums, n = x.sum(0), len(x)
    whole = x * n - sums
    exact = [sum(int(c) ** 2 for c in one) for one in whole]
    centred = (whole / n).astype(float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    rank = 4 if kind == "flat" else 6
    assert sorted(got["component"].unique()) == list(range(1, rank + 1))
    assert (got["n"] == n).all() and (got["identity_error"] < 1e-8).all()
    for k in range(rank):
        part = got[got["component"] == k + 1].sort_values("vec_id")
        expected = centred @ axes[:, k] / np.sqrt(values[k])
        sign = np.sign(expected @ part["whitened"])
        assert np.allclose(part["whitened"], sign * expected, atol=1e-6)
        assert np.allclose(part["explained"], values[k] / values.sum(), rtol=1e-6)
        fits = [e if e < 1 << 63 else None for e in exact]
        if None in fits:
            assert part["deviation"].isna().tolist() == [e is None for e in fits]
        else:
            assert part["deviation"].tolist() == fits


def test_whitening_leaves_unsound_vectors_out(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 3.5]), (2, None), (3, [nan, 1.0]),
            (4, [float("-inf"), 1.0]), (5, [None, 1.0]), (6, []), (None, [2.0, 1.0]),
            (7, [1e30, 1.0]), (8, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = wh.whitened(df).toPandas()
    assert len(got) == 8 and set(got["n"]) == {4} and got["vec_id"].isna().sum() == 2
    assert wh.whitened(df.limit(0)).count() == 0
    assert wh.whitened(df.where("vec_id = 1")).count() == 0


def test_ill_conditioned_rows_become_orthogonal(spark):
    """Singular values that differ by 1e6 need more than one shifted pass."""
    draw = np.random.default_rng(1)
    v = draw.normal(size=(500, 4)) * [1e6, 1e3, 10, 1] @ np.linalg.qr(draw.normal(size=(4, 4)))[0]
    got = wh.whitened(framed(spark, v)).toPandas()
    assert got["component"].max() == 4 and got["identity_error"].max() < 1e-4


def test_triangular_solves():
    draw = np.random.default_rng(2)
    rows, r = draw.normal(size=(9, 4)), np.triu(draw.normal(size=(4, 4))) + 3 * np.eye(4)
    assert np.allclose(wh.solved(rows, [r, r]) @ r @ r, rows)


# -- exact duplicates ------------------------------------------------------------

TEXTS = ["a b", "a\tb", "a  b", "a b ", "", None, " ", "\n\n", "b a", "é" * 40, "é" * 39 + "e",
         "x" * 500, "x" * 499 + "y", "x" * 500, "long " * 300, "long\n" * 300, "a b"]


def brute_groups(rows):
    groups = defaultdict(list)
    for id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        first = min(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        taken = False
        for id in ids:
            out.append((id, first, len(ids), id == first and not taken, digest))
            taken = taken or id == first
    return sorted(out, key=str)


@pytest.mark.parametrize("primes,huge", [(fp.PRIMES, fp.HUGE), (fp.PRIMES, 100), ((3, 2), 100),
                                         ((1, 1), fp.HUGE), ((1, 1), 100)])
def test_exact_duplicates_equal_brute_force(spark, primes, huge, monkeypatch):
    """Also where texts are cut into many chunks, and where fingerprints collide."""
    monkeypatch.setattr(fp, "SALT_ROWS", 2)
    rows = [(100 - i, t) for i, t in enumerate(TEXTS)] + [(7, "a b"), (7, "a b"), (None, "a b"),
                                                          (None, "only"), (None, "only")]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows],
                               "doc_id long, text string, kept string, group_size int")
    got = fp.exact_duplicates(df, keep=["doc_id"], chunk=16, huge=huge, primes=primes,
                              measures={"sha": F.sha2("normal", 256)}).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["sha"])
                   for r in got), key=str) == brute_groups(rows)


def test_kept_documents(spark):
    df = spark.createDataFrame([(2, "a b", 1), (1, "a  b", 2), (3, None, 3)],
                               "doc_id long, text string, keep_id int")
    got = fp.kept_documents(df)
    assert got.columns == df.columns
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a  b", 2), (3, None, 3)]
    assert fp.kept_documents(df.limit(0)).count() == 0
    assert fp.exact_duplicates(df).columns == ["doc_id", "keep_id", "group_size", "kept"]


def test_fingerprints_compose():
    data = bytes(range(256)) * 3
    whole = fp.chunk_element(data, fp.powers(1024))
    for cut in (0, 1, 300, len(data)):
        parts = [fp.chunk_element(p, fp.powers(1024)) for p in (data[:cut], data[cut:])]
        assert fp.combined(parts) == (whole[0], whole[2])
    value = 0
    for b in data:
        value = (value * fp.BASES[0] + b) % fp.PRIMES[0]
    assert value == whole[0]


# -- prefix trie -----------------------------------------------------------------

def brute_nodes(convs):
    """Nodes of {conv_id: [(role, text)]}, straight from the definition."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for path, who in members.items():
        below = [p for p in members if p[:len(path)] == path]
        childless = [p for p in below if not any(
            len(q) == len(p) + 1 and q[:len(p)] == p for q in members)]
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(path))
        out.append((
            min(who), len(path), min(members[path[:-1]]) if path else None, len(who),
            sum(len(p) == len(path) + 1 for p in below), len(childless),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
            hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256"]


def turns_of(spark, convs):
    rows = [(c, i, r, t, "x") for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    return spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, depth string")


def made_conversations(kind):
    draw = np.random.default_rng(11)
    out = {}
    for c in range(160):
        size = int(draw.integers(1, 7))
        turns = [("u" if i % 2 else "a", "é" * int(draw.integers(0, 3))) for i in range(size)]
        if kind == "hot" and c % 3:
            turns = [("u", "same"), ("a", "again")][:1 + c % 2]
        if kind == "hot turn":
            turns = [("u", "hello")] + turns
        if kind == "long":
            turns = [("u", "x")] * int(draw.integers(1, 60))
        out[c * 3 - 40] = turns
    return out


@pytest.mark.parametrize("kind", ["mixed", "hot", "hot turn", "long"])
@pytest.mark.parametrize("nodes,conversations", [(1 << 18, 1 << 17), (4, 1 << 17), (1 << 18, 1)])
def test_trie_equals_brute_force(spark, kind, nodes, conversations):
    """Whole, and with shards so small that most nodes lie in several."""
    convs = made_conversations(kind)
    made = pt.prefix_trie(pt.sequences(pt.turn_lists(turns_of(spark, convs))),
                          max_nodes=nodes, max_conversations=conversations)
    got = sorted((tuple(r[c] for c in COLUMNS) for r in made.collect()), key=str)
    assert got == brute_nodes(convs)


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - int(np.fmod(c, 5)), [])[:h] + turns[h:]
    return out


def test_shared_heads(spark):
    convs = {c: [("u", f"{c} {i}") for i in range(1 + c % 11)] for c in range(0, 60) if c % 15}
    lists = pt.with_shared_heads(pt.turn_lists(turns_of(spark, convs)))
    made = pt.prefix_trie(pt.sequences(lists))
    got = sorted((tuple(r[c] for c in COLUMNS) for r in made.collect()), key=str)
    assert got == brute_nodes(rebuilt(convs))
    assert any(not turns for turns in rebuilt(convs).values())


def test_turns_in_any_shape(spark):
    rows = [(1, None, None, None), (1, 2, "u", "b"), (1, 1, "u", "a"), (1, 1, "u", "a"),
            (None, 1, "u", "a"), (2, None, "", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = pt.prefix_trie(pt.sequences(pt.turn_lists(df)))
    got = sorted((tuple(r[c] for c in COLUMNS) for r in made.collect()), key=str)
    assert got == brute_nodes({1: [("", ""), ("u", "a"), ("u", "a"), ("u", "b")], 2: [("", "")]})
    assert pt.prefix_trie(pt.sequences(pt.turn_lists(df.limit(0)))).count() == 0


@pytest.mark.parametrize("size", [1, 2, 40, 3000])
def test_closes_are_found(size):
    draw = np.random.default_rng(size)
    bits, depth = [], 0
    for left in range(2 * size, 0, -1):
        up = depth == 0 or (depth < left and draw.random() < (0.5 if size < 3000 else 0.7))
        bits.append(up)
        depth += 1 if up else -1
    stack, close = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            close[stack.pop()] = i
    for block in (2, 64):
        tree = pt.Parentheses(np.array(bits), block)
        places = np.array(sorted(close))
        assert tree.find_close(places).tolist() == [close[p] for p in sorted(close)]
