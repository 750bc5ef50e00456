"""Connected components of links, without a group in one task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from redress.llm.common import map_batches
from redress.sources.scratch import settle


#: Links that one task holds as a union-find at most.
TOGETHER = 500_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one task: each node with the smallest node it reaches."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while (up := parent.get(x, x)) != root:
            parent[x], x = root, up
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                low, high = min(a, b), max(a, b)
                parent[high] = low
                parent.setdefault(low, low)
    nodes = [x for x in parent if find(x) != x]
    for start in range(0, len(nodes), 65_536):
        part = nodes[start : start + 65_536]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int64()), pa.array([find(x) for x in part], pa.int64())],
            names=["u", "v"],
        )


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` of every node of ``links`` (a, b: long), by the smallest node.

    Each task first contracts its links with union-find; up to ``TOGETHER`` links are
    contracted in one, and that is all. Then the nodes hang
    themselves on the smallest neighbour, alternately over larger and over smaller
    ones, until nothing changes; the number of rounds grows with the logarithm of
    the size. Neighbours are combined by minimum, so a node with any number of them
    is no group in a task, and each round is a stored table.
    """
    parts = -(-links.count() // TOGETHER)
    spread = links.select("a", "b").repartition(max(1, parts))
    edges = settle(spread.transform(map_batches, _forest, "u long, v long"), "forest")
    while parts > 1 and not _is_final(edges):
        # u > v. Larger neighbours and the node itself get the smallest of all.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        large = (
            edges.select(F.col("v").alias("u"), F.col("u").alias("larger"))
            .join(least, "u")
            .select(F.col("larger").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        # Smaller neighbours get the smallest of them, and so does the node.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
        )
        edges = settle(small.transform(map_batches, _forest, "u long, v long").distinct(), "forest")
    own = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return own.distinct().unionByName(roots)


def _is_final(edges: DataFrame) -> bool:
    """Whether every node hangs on one root, and no root on another node."""
    per_node = edges.groupBy("u").agg(F.min("v").alias("l"), F.max("v").alias("m"))
    if per_node.where("l < m").take(1):
        return False
    nodes = edges.select("u").distinct()
    return not edges.select(F.col("v").alias("u")).distinct().join(nodes, "u", "semi").take(1)
