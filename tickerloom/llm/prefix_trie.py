"""The prefix trie of conversations, in balanced parentheses.

Every conversation is a sequence of turns, each a digest of role and text with the
bytes of its text. Sequences are range-partitioned and sorted, so a shard is a
stretch of the sorted order and its trie is a contiguous part of the whole one.
A shard writes its trie as parentheses in preorder, with the least excess of each
block and of ranges of blocks above them: finding the close of a node delimits its
subtree, ranks of "()" count the leaves in it, and cumulative arrays over the
preorder give members and savings as differences.

Only nodes on the first or last path of a shard can also lie in another one. How
deep neighbours agree is known from the ends of the partitions, so a shard counts
as new only what the shard before does not have, and as leaf only what the next
one does not continue; all figures of such a spine node then add up over its
shards. A partition is cut into shards of bounded size, so a hot turn or a hot
conversation is spread over many.

Defined results: a null conversation id takes no part; null role or text is empty;
turns are ordered with null first, equal ones by the digest of role and text;
repeated rows are repeated turns; an empty table gives no rows; other columns are
not read. The turns of one conversation, 24 bytes each, have to fit one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerloom.llm.common import BROADCAST_IDS, arrow_ready, arrow_schema, table

DIGEST = 16  # bytes of a turn's digest
BLOCK = 64  # parentheses of a block
SHARD_NODES, SHARD_CONVERSATIONS = 1 << 18, 1 << 17
FAMILY = 5  # the shared head is that of the conversation at the last multiple
HEADS = 9  # a shared head has fewer turns than this
NO_ENDS = hashlib.sha256().hexdigest()
FIGURES = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
NODE = ("node binary, parent binary, shard long, conv_id long, depth long, "
        "parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string, ends string")


class Parentheses:
    """Balanced parentheses with blocks of least excess, searched from many places at once."""

    def __init__(self, opens: np.ndarray, block: int = BLOCK):
        self.block = block
        n = len(opens)
        self.bits = opens.astype(bool)
        self.excess = np.cumsum(np.where(self.bits, 1, -1))
        self.rank = np.concatenate([[0], np.cumsum(self.bits)])  # opens before a place
        leaf = np.zeros(n, bool)
        leaf[:-1] = self.bits[:-1] & ~self.bits[1:]
        self.leaf = leaf
        blocks = -(-n // block)
        padded = np.full(blocks * block, np.iinfo(np.int64).max)
        padded[:n] = self.excess
        size = 1 << max(blocks - 1, 0).bit_length()
        self.least = np.full(2 * size, np.iinfo(np.int64).max)
        self.least[size:size + blocks] = padded.reshape(blocks, block).min(1)
        for level in range(size - 1, 0, -1) if size < 64 else ():
            self.least[level] = min(self.least[2 * level], self.least[2 * level + 1])
        if size >= 64:
            width = size
            while width > 1:
                half = width // 2
                self.least[half:width] = self.least[width:2 * width].reshape(half, 2).min(1)
                width = half
        self.size = size

    def find_close(self, places: np.ndarray) -> np.ndarray:
        """The place of the closing parenthesis of each opening one."""
        target = self.excess[places] - 1
        found = self._scan(places + 1, target)
        left = np.flatnonzero(found < 0)
        # Climb until a block to the right falls as low as the target, then go down.
        tree = self.size + places[left] // self.block
        goal = target[left]
        climbing = np.ones(len(left), bool)
        while climbing.any():
            right = (tree & 1 == 0) & climbing
            hit = np.zeros(len(left), bool)
            hit[right] = self.least[tree[right] + 1] <= goal[right]
            tree = np.where(hit, tree + 1, np.where(climbing, tree >> 1, tree))
            climbing &= ~hit
        while len(tree) and tree[0] < self.size or (tree < self.size).any():
            inner = tree < self.size
            low = self.least[np.where(inner, 2 * tree, 0)] <= goal
            tree = np.where(inner, 2 * tree + np.where(low, 0, 1), tree)
        found[left] = self._scan((tree - self.size) * self.block, goal)
        return found

    def _scan(self, starts: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The first place from ``starts`` to the end of its block with the target's excess."""
        found = np.full(len(starts), -1)
        at = np.arange(len(starts))
        places = starts.copy()
        ends = np.minimum((np.maximum(starts - 1, 0) // self.block + 1) * self.block,
                          len(self.excess))
        ends = np.where(starts % self.block == 0, np.minimum(starts + self.block,
                                                             len(self.excess)), ends)
        while True:
            alive = places < ends
            at, places, ends, target = at[alive], places[alive], ends[alive], target[alive]
            if not len(at):
                return found
            hit = self.excess[places] == target
            found[at[hit]] = places[hit]
            at, places, ends, target = at[~hit], places[~hit] + 1, ends[~hit], target[~hit]


def common_turns(a: bytes, b: bytes) -> int:
    """Turns at the beginning that two sequences share."""
    n = min(len(a), len(b)) // DIGEST
    if a[:n * DIGEST] == b[:n * DIGEST]:
        return n
    low, high = 0, n
    while low < high - 1:  # equal up to low, different up to high
        middle = (low + high) // 2
        if a[low * DIGEST:middle * DIGEST] == b[low * DIGEST:middle * DIGEST]:
            low = middle
        else:
            high = middle
    return low


def shard_nodes(shard: int, convs: list[int], keys: list[bytes], sizes: list[list[int]],
                before: int, after: int) -> dict[str, list]:
    """The nodes of a shard, as columns of NODE.

    ``before`` and ``after`` are the turns that its first sequence shares with the
    shard before and its last one with the shard behind, -1 without such a shard.
    """
    opens, depth, parent, weight = bytearray([1]), [0], [-1], [0]
    ends = [[0, 0]]  # first and last own members of a node, as places in convs
    path, last = [0], b""
    for place, (key, bytes_) in enumerate(zip(keys, sizes)):
        shared = common_turns(last, key)
        opens.extend(bytes(len(path) - 1 - shared))
        del path[shared + 1:]
        for turn in range(shared, len(key) // DIGEST):
            opens.append(1)
            parent.append(path[-1])
            path.append(len(depth))
            depth.append(turn + 1)
            weight.append(bytes_[turn])
            ends.append([0, 0])
        own = ends[path[-1]]
        own[0], own[1] = (own[0] if own[1] else place), place + 1
        last = key
    opens.extend(bytes(len(path)))

    tree = Parentheses(np.frombuffer(bytes(opens), np.uint8))
    at = np.flatnonzero(tree.bits)
    close = tree.find_close(at)
    n = len(at)
    first, behind = np.arange(n), tree.rank[close]
    depth, parent, weight = (np.array(x, np.int64) for x in (depth, parent, weight))
    ends = np.array(ends, np.int64)
    members = np.array(convs, np.int64)

    known = np.zeros(n, bool)  # nodes the shard before has as well
    known[:before + 1] = True
    ongoing = np.zeros(n, bool)  # nodes the next shard has as well
    ongoing[path[:after + 1]] = True
    spine = known | ongoing

    def within(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[behind] - total[first]

    leaf = tree.leaf.copy()
    leaf[at[ongoing]] = False
    leaves = np.concatenate([[0], np.cumsum(leaf)])
    n_convs = within(ends[:, 1] - ends[:, 0])
    low = np.full(n, np.iinfo(np.int64).max)
    own = ends[:, 1] > 0
    low[own] = members[ends[own, 0]]
    order = np.argsort(depth, kind="stable")
    bounds = np.searchsorted(depth[order], np.arange(depth.max() + 2))
    for d in range(len(bounds) - 2, 0, -1):
        some = order[bounds[d]:bounds[d + 1]]
        np.minimum.at(low, parent[some], low[some])

    names: dict[int, bytes] = {}
    for nodes, key in ((range(before + 1), keys[0]), (path[:after + 1], keys[-1])):
        digest = hashlib.md5()
        for d, node in enumerate(nodes):
            digest.update(key[(d - 1) * DIGEST:d * DIGEST] if d else b"")
            names[int(node)] = digest.digest()

    def joined(i: int) -> str:
        return ",".join(map(str, convs[ends[i, 0]:ends[i, 1]]))

    return {
        "node": [names.get(i) for i in range(n)],
        "parent": [names.get(p) for p in parent.tolist()],
        "shard": [shard] * n, "conv_id": low, "depth": depth,
        "parent_conv_id": [None if p < 0 or spine[p] else int(low[p]) for p in parent.tolist()],
        "n_convs": n_convs,
        "n_children": np.bincount(parent[~known & (parent >= 0)], minlength=n),
        "n_leaves": leaves[close] - leaves[at],
        "saved_tokens": within(n_convs * weight) - within(np.where(known, 0, weight)),
        "ends_sha256": [NO_ENDS if not o else None if s else hashlib.sha256(
            joined(i).encode()).hexdigest() for i, (o, s) in enumerate(zip(own, spine))],
        "ends": [joined(i) if o and s else None for i, (o, s) in enumerate(zip(own, spine))],
    }


def _shards(borders: dict[int, tuple[int, int]], max_nodes: int, max_conversations: int):
    """Task: the rows (part, conv_id, key, sizes) of a partition, in order, to nodes."""
    arrow = arrow_schema(NODE)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        number, before, part = 0, -1, None
        convs, keys, sizes, nodes = [], [], [], 1

        def flush(after: int):
            made = shard_nodes(part << 32 | number, convs, keys, sizes, before, after)
            whole = pa.RecordBatch.from_arrays(
                [pa.array(made[f.name], f.type) for f in arrow], names=arrow.names)
            for start in range(0, whole.num_rows, 4096):
                yield whole.slice(start, 4096)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if part is None:
                    part = row[0]
                    before = borders[part][0]
                if len(convs) >= max_conversations or nodes >= max_nodes:
                    after = common_turns(keys[-1], row[2])
                    yield from flush(after)
                    number, before = number + 1, after
                    convs, keys, sizes, nodes = [], [], [], 1
                nodes += len(row[3]) - (common_turns(keys[-1], row[2]) if keys else 0)
                convs.append(row[1])
                keys.append(row[2])
                sizes.append(row[3])
        if convs:
            yield from flush(borders[part][1])

    return run


def _borders(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Turns each partition's first and last sequence share with its neighbours'.

    Two rows per partition meet in a window over the partitions; three numbers of
    each come to the driver.
    """
    spans = rows.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    order = Window.orderBy("part")
    near = spans.select("part", "low", "high", F.lag("high").over(order).alias("left"),
                        F.lead("low").over(order).alias("right"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            made = [(p, -1 if left is None else common_turns(left, low),
                     -1 if right is None else common_turns(high, right))
                    for p, low, high, left, right in zip(*(c.to_pylist() for c in batch.columns))]
            columns = list(zip(*made)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in columns],
                                             names=["part", "before", "after"])

    made = near.mapInArrow(run, "part int, before int, after int")
    return {r["part"]: (r["before"], r["after"]) for r in made.collect()}


def _ends_digests(pieces: DataFrame) -> DataFrame:
    """(node, ends_sha256): the pieces of a node's member list, hashed as they stream by."""
    arrow = arrow_schema("node binary, ends_sha256 string")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        node, digest = None, None
        for batch in batches:
            done = []
            for one, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if one != node:
                    if digest is not None:
                        done.append((node, digest.hexdigest()))
                    node, digest = one, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(piece.encode())
            columns = list(zip(*done)) or [(), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, arrow)], names=arrow.names)
        if digest is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip((node, digest.hexdigest()), arrow)],
                names=arrow.names)

    return (pieces.repartition("node").sortWithinPartitions("node", "shard")
            .select("node", "ends").mapInArrow(run, "node binary, ends_sha256 string"))


def prefix_trie(sequences: DataFrame, max_nodes: int = SHARD_NODES,
                max_conversations: int = SHARD_CONVERSATIONS) -> DataFrame:
    """The trie's nodes, of sequences (conv_id, key, sizes).

    ``key`` holds the digests of the turns one after the other, ``sizes`` the bytes
    of their texts. Columns conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    arrow_ready(sequences.sparkSession)
    rows = (sequences.select("conv_id", "key", "sizes").repartitionByRange("key", "conv_id")
            .sortWithinPartitions("key", "conv_id").checkpoint()
            .select(F.spark_partition_id().alias("part"), "conv_id", "key", "sizes"))
    nodes = rows.mapInArrow(_shards(_borders(rows.select("part", "key")), max_nodes,
                                    max_conversations), NODE).checkpoint()
    parts = nodes.where("node is not null")
    spine = parts.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"), *[F.sum(c).alias(c) for c in FIGURES])
    digests = _ends_digests(parts.where("ends is not null").select("node", "shard", "ends"))
    spine = spine.join(digests, "node", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))).checkpoint()
    parents = spine.select(F.col("node").alias("parent"), F.col("conv_id").alias("of"))
    if spine.count() <= BROADCAST_IDS:
        parents = F.broadcast(parents)
    figures = ["conv_id", "depth", "parent", "parent_conv_id", *FIGURES, "ends_sha256"]
    every = nodes.where("node is null").select(*figures).unionByName(
        spine.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*figures))
    return every.join(parents, "parent", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "of")).drop("parent", "of")


def turn_lists(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
               text: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns (digest in hex, bytes) in order."""
    said = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    by = F.coalesce(F.col(f"`{role}`"), F.lit(""))
    digest = F.md5(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said))
    turns = df.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"),
        F.struct(F.col(f"`{turn}`").alias("turn"), digest.alias("digest"),
                 F.octet_length(said).alias("bytes")).alias("one"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))


def sequences(lists: DataFrame) -> DataFrame:
    """(conv_id, key, sizes) of turn lists."""
    return lists.select("conv_id", F.unhex(F.array_join(F.transform(
        "turns", lambda t: t["digest"]), "")).alias("key"),
        F.transform("turns", lambda t: t["bytes"]).alias("sizes"))


def with_shared_heads(lists: DataFrame) -> DataFrame:
    """Conversations whose first h turns are those of the conversation c - c % FAMILY.

    h is the CRC-32 of the id's decimal digits modulo HEADS.
    """
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = lists.select(F.col("conv_id").alias("family"),
                         F.slice("turns", 1, HEADS - 1).alias("head"))
    return (lists.withColumns({"family": family, "h": F.expr(
        f"int(crc32(cast(conv_id as string)) % {HEADS})")})
        .join(heads, "family", "left")
        .select("conv_id", F.expr(
            "concat(if(head is null, slice(turns, 1, 0), slice(head, 1, h)), "
            "slice(turns, h + 1, greatest(size(turns) - h, 0)))").alias("turns")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = turn_lists(table(spark, sf_dir, "conversations")).checkpoint()
    return prefix_trie(sequences(with_shared_heads(lists)))


QUERIES = {"op13_prefix_trie": op13_prefix_trie}
ORACLES = {"op13_prefix_trie": f"""
WITH turns AS (
  SELECT conv_id, strlen(coalesce(text, '')) AS bytes, turn,
         md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS k
  FROM turns),
ids AS (
  SELECT conv_id, conv_id - conv_id % {FAMILY} AS family,
         xor(list_reduce([4294967295::BIGINT] || list_transform(
               string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
             lambda c, b: xor(c >> 8, list_reduce(
               [xor(c, b) & 255] || range(8),
               lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::BIGINT)
                                 ELSE r >> 1 END))), 4294967295::BIGINT) % {HEADS} AS h
  FROM (SELECT DISTINCT conv_id FROM placed)),
rebuilt AS (
  SELECT i.conv_id, 0 AS own, k, digest, bytes FROM ids i
  JOIN placed p ON p.conv_id = i.family AND k <= h
  UNION ALL
  SELECT i.conv_id, 1, k, digest, bytes FROM ids i JOIN placed p ON p.conv_id = i.conv_id AND k > h),
paths AS (
  SELECT conv_id, bytes, string_agg(digest, '') OVER w AS path, row_number() OVER w AS depth,
         count(*) OVER (PARTITION BY conv_id) AS length
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, k)),
members AS (
  SELECT conv_id, path, depth, length, bytes FROM paths
  UNION ALL SELECT conv_id, '', 0, coalesce(length, 0), 0 FROM ids
  LEFT JOIN (SELECT conv_id, max(length) AS length FROM paths GROUP BY conv_id) USING (conv_id)),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                  FILTER (WHERE length = depth), '') AS ends
  FROM members GROUP BY path, depth),
children AS (
  SELECT left(path, 32 * (depth::INT - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0
  GROUP BY 1),
figures AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (path)),
above AS (
  SELECT left(path, 32 * unnest(range(0, depth::INT + 1))) AS top,
         CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * bytes AS saved
  FROM figures),
subtrees AS (
  SELECT top AS path, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY top)
SELECT f.conv_id, f.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens,
       sha256(f.ends) AS ends_sha256
FROM figures f JOIN subtrees s ON s.path = f.path
LEFT JOIN nodes p ON f.depth > 0 AND p.path = left(f.path, 32 * (f.depth::INT - 1))"""}
