"""Token counts, byte-level BPE and packing against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tickerloom.llm import bpe, packing, pieces, tokens

TEXTS = [None, "", " ", "word", "  two  spaces ", "a b\nc\td", "don't  we'll", "é ü ß 漢字 🙂",
         "<|endoftext|> inside<|endoftext|>", "x" * 5000, "ab " * 20000, "\n\n \n", "a\x1c b　c",
         "word", "1234 56,78.90 | ### *** !!"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", 7) for i, t in enumerate(TEXTS)] + [(3, "word", "clash", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, length int")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_equal_the_library(docs, library):
    rows = tokens.token_counts(docs).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        text = TEXTS[r["doc_id"]] or ""
        n = len(ids_of(library, text))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (
            len(text.encode()), n, n > 1024), text[:40]


def test_counts_of_other_libraries(docs):
    for name in ("word_bpe_49k.json", "piece_bpe_32k.model"):
        rows = {r["doc_id"]: r["n_tokens"] for r in
                tokens.token_counts(docs, tokenizer=name, keep=["doc_id"]).collect()}
        assert rows[1] == 0 and rows[3] > 0


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert tokens.token_counts(none).count() == 0
    assert bpe.round_trip(none).count() == 0
    assert packing.pack(none, keep=["doc_id"]).count() == 0


def test_safe_places_cut_long_texts_without_effect(library):
    chance = random.Random(3)
    text = "".join(chance.choice(["ab", " ", "  ", "\n", "é", ".", "9"]) for _ in range(4000))
    parts = list(pieces.segments(text, 50))
    assert "".join(parts) == text and len(parts) > 10
    assert [i for p in parts for i in ids_of(library, p)] == ids_of(library, text)
    assert "".join(map(pieces.piece, pieces.keys(text))) == text


def test_bpe_equals_tiktoken_and_comes_back(docs):
    ranks = pieces.load_ranks(pieces.vocabulary(bpe.RANKS))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                            special_tokens={})
    for r in bpe.round_trip(docs).collect():
        text = TEXTS[r["doc_id"]] or ""
        ids = np.array(own.encode_ordinary(text), "<u4")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    back = bpe.decode(bpe.encode(docs.select("doc_id", "text")))
    for r in back.collect():
        assert bytes(r["decoded"]).decode() == (TEXTS[r["doc_id"]] or "")


def test_tree_merges_random_bytes_like_tiktoken():
    codec = bpe.Codec(pieces.vocabulary(bpe.RANKS))
    own = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=codec.ranks,
                            special_tokens={})
    chance = random.Random(1)
    for size in (1, 2, 3, 7, 8, 9, 33, 64, 65, 300):
        texts = ["".join(chance.choice("aeinrst ") for _ in range(size)) for _ in range(30)]
        for text in texts:
            assert bpe.merge(text.encode(), codec.ranks) == own.encode_ordinary(text)
        if size <= 64:
            width = 1 << (size - 1).bit_length()
            found = bpe.merge_many([t.encode() for t in texts], width, codec.byte_ids, codec.pairs)
            for text, ids in zip(texts, found):
                if text.encode() not in codec.ranks:
                    assert ids.tolist() == own.encode_ordinary(text)


@pytest.mark.parametrize("n", [1, 2, 31, 32, 33, 1000, 1024, 1025, 1984, 2047, 2048, 2049, 9999])
def test_cuts_add_up_and_waste_little(n):
    cuts = packing.cut_lengths(n)
    assert sum(cuts) == n and min(cuts) > 0 and max(cuts) <= 2048
    assert len(cuts) <= n // 2048 + 5


def check_packed(rows, ids, capacity=2048):
    by_document, by_sequence = {}, {}
    for r in rows:
        by_document.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert by_document.keys() == ids.keys()
    for doc, some in by_document.items():
        at = 0
        for r in sorted(some, key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids[doc]))
            piece = np.array(ids[doc][at:at + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(piece)
            at += r["length"]
        assert at == len(ids[doc])
    for some in by_sequence.values():
        at = 0
        for r in sorted(some, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_sequence)


def test_packing_is_a_partition_of_all_ids(spark, docs, library):
    some = docs.dropDuplicates(["doc_id"])
    ids = {i: ids_of(library, t) + [1] for i, t in enumerate(TEXTS)}
    check_packed(packing.pack(some, keep=["doc_id"]).collect(), ids)
    repeated = docs.where("doc_id = 3")
    assert packing.pack(repeated, keep=["doc_id"]).count() == 2


def test_packing_the_documents_wastes_little(spark, sf_dir, library):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = {r["doc_id"]: ids_of(library, r["text"]) + [1] for r in table.collect()}
    n = check_packed(packing.pack(table, keep=["doc_id"]).collect(), ids)
    assert n * 2048 < 1.05 * sum(map(len, ids.values())) + 2048


def test_groups_fill_their_bins_apart(spark):
    lengths = spark.range(5000).selectExpr("id as doc_id", "1 + id % 700 as length")
    rows = packing.harmonic_pack(lengths, 1000, group=64).collect()
    used = {}
    for r in rows:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert len(rows) == 5000
    for some in used.values():
        some.sort()
        assert [o for o, _ in some] == [sum(n for _, n in some[:i]) for i in range(len(some))]
        assert sum(n for _, n in some) <= 1000


def test_packing_goes_through_any_white_space(spark):
    """A run of blanks that the fast encoder's pattern cannot go through."""
    texts = [" " * 2_000_000 + "x", "a\n" + "\n" * 1_000_000, "plain text"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    library = pieces.load_tokenizer(pieces.vocabulary("byte_bpe_50k.json"))
    got = {}
    for r in packing.token_pieces(df, with_ids=True).orderBy("doc_id", "start").collect():
        got.setdefault(r["doc_id"], []).extend(r["ids"])
    for i, text in enumerate(texts):
        assert got[i] == library.encode(text, add_special_tokens=False).ids + [packing.END_ID]
