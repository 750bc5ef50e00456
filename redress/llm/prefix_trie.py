"""Prefix trie of conversations: sorted shards, and a skeleton between them."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from redress.llm.common import map_batches
from redress.sources.scratch import settle, shared_folder

#: Bytes of a turn in a path.
TURN = 16
#: Conversations of a shard, about; a task holds the nodes of one.
SHARD_ROWS = 50_000
#: Ids that one row of a skeleton node's ends holds.
CHUNK = 1024
#: Skeleton nodes that are broadcast at most (40 bytes each).
BROADCAST_NODES = 1_000_000
NOTHING = hashlib.sha256(b"").hexdigest()
_ROWS = (
    "node binary, parent binary, depth long, chars long, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
    "shard long, chunk long, ends string"
)
_ARROW = pa.schema([
    (name, {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}[kind])
    for name, kind in (field.split() for field in _ROWS.split(", "))
])


def conversation_paths(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``path``, ``chars``: a conversation as one sortable value.

    A path is the 16-byte digests of the turns (role, text) in order, so paths that
    begin alike are neighbours in byte order; ``chars`` has the code points of each
    text. Texts are not shuffled. Turns stand by ``turn`` (NULL first); ties stand by
    their digest, so repeated rows all stay and have a fixed place. NULL role or text:
    empty. Rows without a ``conv_id`` belong to no conversation and are left out.
    Ids are integers; other columns are ignored.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.unhex(F.md5(whole)).alias("digest"),
        F.length(text).alias("chars"),
    )
    return (
        turns.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("_turn"))
        .where("conv_id IS NOT NULL")
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
        .select(
            "conv_id",
            F.aggregate(
                "_turns", F.lit(b""), lambda path, t: F.concat(path, t["digest"])
            ).alias("path"),
            F.transform("_turns", lambda t: t["chars"]).alias("chars"),
        )
    )


def share_openings(paths: DataFrame, group: int = 100, longest: int = 5) -> DataFrame:
    """Each conversation with its first turns taken from the first of its group.

    Conversation c keeps what follows its first h turns, h being the CRC-32 of its
    decimal id modulo ``longest + 1``; before that stand the first h turns of
    conversation ``c - c % group`` (all if it has fewer, none if there is none); a
    remainder has the sign of c, as in SQL.
    """
    head, h = F.col("conv_id") - F.col("conv_id") % group, F.col("_h")
    heads = paths.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("_head"),
        F.substring("path", 1, longest * TURN).alias("_path"),
        F.slice("chars", 1, longest).alias("_chars"),
    )
    number = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)
    own = paths.withColumns({"_head": head, "_h": number.cast("int")})
    n = F.size("chars")

    def begin(path: Column) -> Column:
        return F.substring(path, F.lit(1), h * TURN)

    return own.join(heads, "_head", "left").select(
        "conv_id",
        F.concat(
            begin(F.coalesce("_path", F.lit(b""))),
            F.substring("path", h * TURN + 1, F.length("path")),
        ).alias("path"),
        F.concat(
            F.slice(F.coalesce("_chars", F.array().cast("array<int>")), F.lit(1), h),
            F.slice("chars", h + 1, F.greatest(n - h, F.lit(0))),
        ).alias("chars"),
    )


def _shared_turns(a: bytes, b: bytes) -> int:
    """Turns at which two paths begin alike."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // TURN
    low, high = 0, most // TURN
    while low < high - 1:  # the first `low` turns are equal, the first `high` are not
        middle = (low + high) // 2
        low, high = (middle, high) if a[: middle * TURN] == b[: middle * TURN] else (low, middle)
    return low


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shard, its first path, the last path before it -> shard, turns that both begin with."""
    for batch in batches:
        pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
        shared = [-1 if before is None else _shared_turns(first, before) for first, before in pairs]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(shared, pa.int64())], names=["shard", "shared"]
        )


class _Shard:
    """The trie of one shard, built from its conversations in order of path and id.

    A node is a row of the arrays; the stack holds those of the path just read. A node
    that the shards before or after have too (the skeleton: the turns that splitters
    share with their neighbours) is a partial result, all others are finished here.
    """

    def __init__(self, shard: int, left: int, right: int, chunk: int):
        self.shard, self.left, self.right, self.chunk = shard, left, right, chunk
        self.last = b""
        self.stack: list[int] = []
        self.ends: dict[int, list[int]] = {}
        self.skeleton: dict[int, tuple[bytes, bytes | None]] = {}
        self.opened_first: set[int] = set()
        (self.parent, self.depth, self.chars, self.least, self.convs, self.children,
         self.leaves, self.saved) = (array("q") for _ in range(8))

    def open(self, chars: int) -> int:
        node = len(self.parent)
        self.parent.append(self.stack[-1] if self.stack else -1)
        self.depth.append(len(self.stack))
        self.chars.append(chars)
        self.least.append((1 << 63) - 1)
        for column in (self.convs, self.children, self.leaves, self.saved):
            column.append(0)
        self.stack.append(node)
        return node

    def read(self, conv_id: int, path: bytes, chars: list[int]) -> None:
        turns = len(path) // TURN
        if not self.stack:
            self.open(0)
            for k in range(turns):
                self.open(chars[k])
            self.opened_first = set(self.stack[: self.left + 1])
        elif path != self.last:
            shared = _shared_turns(path, self.last)
            self.close(shared, at_end=False)
            for k in range(shared, turns):
                self.open(chars[k])
        node = self.stack[-1]
        self.ends.setdefault(node, []).append(conv_id)
        self.convs[node] += 1
        self.least[node] = min(self.least[node], conv_id)
        self.last = path

    def close(self, depth: int, at_end: bool) -> None:
        """Finish the nodes of the stack that are deeper than ``depth``."""
        names: list[bytes] = []
        while len(self.stack) > depth + 1:
            node = self.stack.pop()
            level, up = self.depth[node], self.parent[node]
            if up >= 0:
                self.convs[up] += self.convs[node]
                self.least[up] = min(self.least[up], self.least[node])
            if node in self.opened_first or (at_end and level <= self.right):
                names = names or _names(self.last)
                self.skeleton[node] = (names[level], names[level - 1] if level else None)
                continue
            self.leaves[node] = self.leaves[node] or 1
            self.saved[node] += (self.convs[node] - 1) * self.chars[node]
            if up >= 0:
                self.children[up] += 1
                self.leaves[up] += self.leaves[node]
                self.saved[up] += self.saved[node]

    def rows(self) -> Iterator[tuple]:
        for node in range(len(self.parent)):
            up, ends = self.parent[node], self.ends.get(node, [])
            name, above = self.skeleton.get(node, (None, None))
            sums = (self.convs[node], self.children[node], self.leaves[node], self.saved[node])
            if name is not None:
                fixed = (name, above, self.depth[node], self.chars[node])
                yield *fixed, self.least[node], None, *sums, None, self.shard, -1, None
                for start in range(0, len(ends), self.chunk):
                    text = ",".join(map(str, ends[start : start + self.chunk]))
                    yield *fixed, *[None] * 7, self.shard, start // self.chunk, text
                continue
            digest = NOTHING
            if ends:
                digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
            above = self.skeleton[up][0] if up in self.skeleton else None
            yield (
                None, above, self.depth[node], self.chars[node], self.least[node],
                None if above is not None else self.least[up], *sums, digest,
                self.shard, None, None,
            )


def _names(path: bytes) -> list[bytes]:
    """The names of all nodes on a path, from the root: digests of its prefixes."""
    digest = hashlib.blake2b(digest_size=TURN)
    names = [digest.digest()]
    for start in range(0, len(path), TURN):
        digest.update(path[start : start + TURN])
        names.append(digest.digest())
    return names


def _build(shared: Broadcast, chunk: int):
    """shard, conv_id, path, chars in order -> finished nodes and parts of skeleton nodes.

    ``shared`` has the turns that each shard shares with the one before and after it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = None
        for batch in batches:
            for shard, conv_id, path, chars in zip(
                *(batch.column(k).to_pylist() for k in range(4)), strict=True
            ):
                trie = trie or _Shard(shard, *shared.value[shard], chunk)
                trie.read(conv_id, path, chars)
        if trie is None:
            return
        trie.close(-1, at_end=True)
        part = []
        for row in trie.rows():
            part.append(row)
            if len(part) == 8192:
                yield _batch(part)
                part = []
        if part:
            yield _batch(part)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Combined skeleton nodes, all of them -> the same with the sums of their subtrees."""
    nodes = {row["node"]: row for batch in batches for row in batch.to_pylist()}
    for node in sorted(nodes.values(), key=lambda x: -x["depth"]):
        node["n_leaves"] = node["n_leaves"] or 1
        node["saved_tokens"] += (node["n_convs"] - 1) * node["chars"]
        if up := nodes.get(node["parent"]):
            up["n_children"] += 1
            up["n_leaves"] += node["n_leaves"]
            up["saved_tokens"] += node["saved_tokens"]
            node["parent_conv_id"] = up["conv_id"]
    names = [
        "node", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens",
    ]
    schema = pa.schema([_ARROW.field(name) for name in names])
    if nodes:
        yield pa.RecordBatch.from_pylist(
            [{name: node.get(name) for name in names} for node in nodes.values()], schema=schema
        )


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of ids in order of node, shard and chunk -> node, hash of its ids."""
    last, digest, done = None, None, []
    for batch in batches:
        for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if node != last:
                if last is not None:
                    done.append((last, digest.hexdigest()))
                last, digest = node, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(text.encode())
    if last is not None:
        done.append((last, digest.hexdigest()))
    if done:
        nodes, hashes = zip(*done, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.binary()), pa.array(hashes, pa.string())],
            names=["node", "ends_sha256"],
        )


def prefix_trie(paths: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The trie of (``conv_id``, ``path``, ``chars``), one row per node.

    A node is a distinct sequence of first turns, from the root without turns; its
    members are the conversations that begin with it. ``conv_id`` is the smallest
    member, which with ``depth`` names the node and its text (the ``depth``-th turn of
    that conversation); ``parent_conv_id`` is the parent's, NULL for the root. Further:
    ``n_convs`` members, ``n_children``, ``n_leaves`` of the subtree, ``saved_tokens``
    (code points that need not be repeated: in the subtree, each node's members but
    one, times its last text) and ``ends_sha256`` over the ids of the conversations
    that end there, ascending and comma-joined. An empty table has no node.

    Conversations are range-partitioned and sorted by path and id, so a large group of
    copies spreads over shards. What a splitter path shares with the path before it is
    the skeleton; its depths are sent to all shards. A shard finishes every other
    node; the parts of skeleton nodes are added up per node, then along the skeleton,
    which has no more nodes than splitter paths have turns. Ends of a skeleton node
    are hashed in order from chunks of so many ids, as a stream.
    """
    spark = paths.sparkSession
    shared_folder(spark)
    paths = settle(paths, "paths")
    parts = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), -(-paths.count() // SHARD_ROWS)
    )
    placed = (
        paths.repartitionByRange(parts, "path", "conv_id")
        .sortWithinPartitions("path", "conv_id")
        .select(F.spark_partition_id().cast("long").alias("shard"), "conv_id", "path", "chars")
        .checkpoint()
    )
    ranges = placed.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    # One row per shard: bounded by their number.
    before = F.lag("last").over(Window.orderBy("shard"))
    found = ranges.select("shard", "first", before.alias("before"))
    left = dict(
        found.transform(map_batches, _overlaps, "shard long, shared long")
        .toLocalIterator()
    )
    order = sorted(left)
    # The root belongs to the skeleton in any case.
    shared = {
        k: (max(0, left[k]), left[order[i + 1]] if i + 1 < len(order) else -1)
        for i, k in enumerate(order)
    }
    sent = spark.sparkContext.broadcast(shared)
    nodes = settle(placed.transform(map_batches, _build(sent, chunk), _ROWS), "trie")

    combined = (
        nodes.where("chunk = -1")
        .groupBy("node", "parent", "depth", "chars")
        .agg(
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        )
    )
    skeleton = settle(
        combined.coalesce(1).transform(
            map_batches,
            _reduce,
            "node binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
            "n_children long, n_leaves long, saved_tokens long",
        ),
        "skeleton",
    )
    hashes = (
        nodes.where("chunk >= 0")
        .select("node", "ends", "shard", "chunk")
        .repartition("node")
        .sortWithinPartitions("node", "shard", "chunk")
        .select("node", "ends")
        .transform(map_batches, _hash_ends, "node binary, ends_sha256 string")
    )
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256",
    ]
    above = skeleton.join(hashes, "node", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))
    )
    names = skeleton.select(F.col("node").alias("parent"), F.col("conv_id").alias("_up"))
    if skeleton.count() <= BROADCAST_NODES:
        names = F.broadcast(names)
    below = (
        nodes.where("node IS NULL")
        .join(names, "parent", "left")
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_up"))
    )
    return above.select(columns).unionByName(below.select(columns))


def trie_table(turns: DataFrame) -> DataFrame:
    """The trie of the conversations with shared openings."""
    return prefix_trie(share_openings(conversation_paths(turns)))
