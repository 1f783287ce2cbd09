"""Byte-level BPE encoding and decoding with a segment tree of pair ranks.

Every match of the split pattern is encoded by itself. Its bytes are the leaves
of a segment tree; the leaf at a live position holds the rank of the pair that
starts there, with the position in its low bits, so the root is the leftmost
pair of the smallest rank. A merge changes three leaves and their ancestors.

Defined results: a null text is empty; an empty text has no ids and decodes to
no bytes; repeated rows come back repeated; columns of the input that are named
like result columns give way to them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import pieces
from tickerloom.llm.common import map_texts, table, without, worker_memo

RANKS = "byte_bpe_50k.tiktoken"
_NONE = 1 << 62
_PLACE_BITS = 32
_PLACE = (1 << _PLACE_BITS) - 1


# Matches of more bytes are merged one by one.
_WIDEST = 64


def _packed(ids) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def merge(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one match of the pattern."""
    whole = ranks.get(data)
    if whole is not None:
        return [whole]
    n = len(data)
    rank = ranks.get
    leaves = 1 << (n - 1).bit_length()
    tree = [_NONE] * (2 * leaves)
    for i in range(n - 1):
        r = rank(data[i:i + 2])
        if r is not None:
            tree[leaves + i] = r << _PLACE_BITS | i
    for node in range(leaves - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a < b else b
    after = list(range(1, n + 1))  # where the token that starts here ends
    before = list(range(-1, n - 1))  # where the token before this one starts
    while tree[1] != _NONE:
        at = tree[1] & _PLACE
        gone = after[at]
        end = after[at] = after[gone]
        if end < n:
            before[end] = at
            r = rank(data[at:after[end]])
            _put(tree, leaves + at, _NONE if r is None else r << _PLACE_BITS | at)
        else:
            _put(tree, leaves + at, _NONE)
        if tree[leaves + gone] != _NONE:
            _put(tree, leaves + gone, _NONE)
        left = before[at]
        if left >= 0:
            r = rank(data[left:end])
            value = _NONE if r is None else r << _PLACE_BITS | left
            if tree[leaves + left] != value:
                _put(tree, leaves + left, value)
    ids, at = [], 0
    while at < n:
        ids.append(ranks[data[at:after[at]]])
        at = after[at]
    return ids


def _put(tree: list[int], node: int, value: int) -> None:
    """Set a leaf; go up only as far as the smallest below a node changes."""
    tree[node] = value
    while node > 1:
        other = tree[node ^ 1]
        node >>= 1
        value = value if value < other else other
        if tree[node] == value:
            return
        tree[node] = value


class PairTable:
    """Ranks of pairs of tokens: (a, b) stands for every split of a token into two tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = sorted((ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items()
                       for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks)
        self.keys = np.array([p for p, _ in pairs] + [_NONE])
        self.ranks = np.array([r for _, r in pairs] + [-1])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 for a pair that never merges."""
        key = a << 32 | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], -1)


def merge_many(matches: list[bytes], width: int, byte_ids: np.ndarray,
               table: PairTable) -> list[np.ndarray]:
    """The ids of many matches of at most ``width`` bytes, a power of two.

    The trees of all matches are the rows of one array, and each round makes
    the next merge of every match that has one.
    """
    n = len(matches)
    sizes = np.array([len(m) for m in matches])
    padded = np.frombuffer(b"".join(m.ljust(width, b"\0") for m in matches), np.uint8)
    token = byte_ids[padded].reshape(n, width)
    place = np.arange(width)
    token = np.hstack([token, np.full((n, 1), -1)])
    after = np.tile(np.arange(1, width + 2), (n, 1))
    before = np.tile(np.arange(-1, width), (n, 1))
    tree = np.full((n, 2 * width), _NONE)
    first = table.of(token[:, :-2], token[:, 1:-1])
    inside = (place[:-1] + 1 < sizes[:, None]) & (first >= 0)
    tree[:, width:-1][inside] = (first << _PLACE_BITS | place[:-1])[inside]
    for node in range(width - 1, 0, -1):
        np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
    alive = place < sizes[:, None]
    row = np.flatnonzero(tree[:, 1] != _NONE)
    while len(row):
        root = tree[row, 1]
        at = root & _PLACE
        gone = after[row, at]
        end = after[row, gone]
        after[row, at] = end
        token[row, at] = root >> _PLACE_BITS
        alive[row, gone] = False
        size = sizes[row]
        more = end < size
        before[row[more], end[more]] = at[more]
        right = np.where(more, table.of(token[row, at], token[row, np.minimum(end, width)]), -1)
        left = before[row, at]
        some = left >= 0
        ahead = np.where(some, table.of(token[row, np.maximum(left, 0)], token[row, at]), -1)
        tree[row, width + at] = np.where(right >= 0, right << _PLACE_BITS | at, _NONE)
        tree[row, width + gone] = _NONE
        rows, lefts = row[some], left[some]
        tree[rows, width + lefts] = np.where(
            ahead[some] >= 0, ahead[some] << _PLACE_BITS | lefts, _NONE)
        for rows, leaf in ((row, gone), (rows, lefts), (row, at)):
            node = width + leaf >> 1
            for _ in range(width.bit_length() - 1):
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                node = node >> 1
        row = row[tree[row, 1] != _NONE]
    counts = alive.sum(axis=1)
    return np.split(token[:, :-1][alive], np.cumsum(counts)[:-1])


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        import regex

        self.ranks = pieces.load_ranks(path)
        self.split = regex.compile(pattern).findall
        self.memo = pieces.PieceMemo(self._pieces)
        self.pairs = PairTable(self.ranks)
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)])
        parts = sorted(self.ranks.items(), key=lambda item: item[1])
        sizes = np.zeros(parts[-1][1] + 1, np.int64)
        sizes[[r for _, r in parts]] = [len(b) for b, _ in parts]
        self.sizes = sizes
        self.starts = np.cumsum(sizes) - sizes
        self.bytes = np.frombuffer(b"".join(b for b, _ in parts), np.uint8)

    def _pieces(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text, those of equal matches found once."""
        matches = [[m.encode() for m in self.split(text)] for text in texts]
        known = {}
        by_width: dict[int, list[bytes]] = {}
        for match in set().union(*matches):
            if match in self.ranks:
                known[match] = _packed([self.ranks[match]])
            elif len(match) > _WIDEST:
                known[match] = _packed(merge(match, self.ranks))
            else:
                by_width.setdefault(1 << (len(match) - 1).bit_length(), []).append(match)
        for width, some in by_width.items():
            found = merge_many(some, width, self.byte_ids, self.pairs)
            known.update(zip(some, map(_packed, found)))
        return [b"".join(map(known.__getitem__, found)) for found in matches]

    def encode(self, text: str) -> bytes:
        """A text's ids as little-endian unsigned 32-bit integers."""
        return self.encode_batch([text])[0]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        return self.memo.apply(texts, b"".join, b"".join)

    def decode(self, packed: bytes) -> bytes:
        """The bytes that the ids stand for, gathered from one table of all tokens."""
        ids = np.frombuffer(packed, "<u4")
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ids):
            return b""
        places = np.arange(ends[-1]) + np.repeat(self.starts[ids] - ends + sizes, sizes)
        return self.bytes[places].tobytes()


def encode(df: DataFrame, text: str = "text", ranks: str = RANKS,
           keep: Iterable[str] | None = None) -> DataFrame:
    """``keep`` (all columns but the text) and ``ids``: array<long>, the text's ids."""
    return _mapped(df, text, ranks, keep, "ids array<long>",
                   lambda codec, packed: {"ids": np.frombuffer(packed, "<u4").astype(np.int64)})


def round_trip(df: DataFrame, text: str = "text", ranks: str = RANKS,
               keep: Iterable[str] | None = None) -> DataFrame:
    """``keep`` and ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of each text.

    The second digest is that of the bytes decoded from the ids.
    """
    return _mapped(df, text, ranks, keep,
                   "n_tokens long, ids_sha256 string, decoded_sha256 string",
                   lambda codec, packed: {
                       "n_tokens": len(packed) // 4,
                       "ids_sha256": hashlib.sha256(packed).hexdigest(),
                       "decoded_sha256": hashlib.sha256(codec.decode(packed)).hexdigest()})


def _mapped(df, text, ranks, keep, ddl, result) -> DataFrame:
    names = [field.split(" ")[0] for field in ddl.split(", ")]
    path = pieces.vocabulary(ranks)
    keep = without(df, [text, *names]).columns if keep is None else keep

    def rows():
        codec = worker_memo(f"codec {path}", lambda: Codec(path))

        def work(texts):
            made = [result(codec, packed) for packed in codec.encode_batch(texts)]
            return {name: [m[name] for m in made] for name in names}

        return work

    return map_texts(df, text, ddl, rows, keep)


def decode(df: DataFrame, ids: str = "ids", ranks: str = RANKS) -> DataFrame:
    """All columns and ``decoded``: binary, the bytes of the ids; null ids give none."""
    path = pieces.vocabulary(ranks)
    rest = without(df, ["decoded"])
    place = rest.columns.index(ids)
    schema = rest.withColumn("decoded", F.lit(None).cast("binary")).schema
    names = schema.names

    def run(batches):
        import pyarrow as pa

        codec = worker_memo(f"codec {path}", lambda: Codec(path))
        for batch in batches:
            made = [codec.decode(np.array(v or [], "<u4").tobytes())
                    for v in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.binary())], names=names)

    return rest.mapInArrow(run, schema)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return round_trip(docs, keep=["doc_id"])


QUERIES = {"op8_bpe": op8_bpe}
ORACLES: dict[str, str] = {}
