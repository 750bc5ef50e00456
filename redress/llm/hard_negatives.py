"""Hard negatives: the nearest rows of other labels within a window of scores."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from redress.llm.vectors import first_rows, matrix, same_width, usable
from redress.sources.scratch import settle
from redress.sources.workers import ship

#: Rows and anchors of a tile at most, about.
TILE_ROWS, TILE_ANCHORS = 65_536, 16_384
#: Scores that a task holds at a time.
TOGETHER = 4_000_000
_LARGEST, _EXACT = (1 << 63) - 1, 1 << 53


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors, exactly; what is no long is the nearest one."""
    anchors, rows = same_width(anchors, rows)
    bound = float(np.abs(anchors.astype(float)).max(initial=0))
    bound *= float(np.abs(rows.astype(float)).max(initial=0)) * anchors.shape[1]
    if bound < _EXACT:  # every partial sum is a whole number that a double holds
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    exact = anchors.astype(object) @ rows.astype(object).T
    return np.clip(exact, -_LARGEST - 1, _LARGEST).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: higher scores first, ties by smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
        return at[np.lexsort((ids[at], ~scores[at]))][:k]
    return np.lexsort((ids, ~scores))[:k]


def _tile(choose, schema: pa.Schema):
    """Anchors and rows of a tile -> what ``choose`` picks of the scores of each anchor."""

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        rows = table.filter(pa.array(side == 1)).sort_by("vec_id")
        anchors = table.filter(pa.array(side == 0)).combine_chunks()
        out: list[tuple] = []
        if rows.num_rows and anchors.num_rows:
            right = matrix(rows.column("vector"), np.int64)
            ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
            step = max(1, TOGETHER // rows.num_rows)
            for start in range(0, anchors.num_rows, step):
                part = anchors.slice(start, step)
                scores = products(matrix(part.column("vector"), np.int64), right)
                asked = part.drop_columns(["vector"]).to_pylist()
                for anchor, own in zip(asked, scores, strict=True):
                    out.extend(choose(anchor, own, ids, labels))
        columns = list(zip(*out, strict=True)) or [[] for _ in schema]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def _positives(k: int):
    def choose(anchor, scores, ids, labels):
        at = np.flatnonzero((labels == anchor["label"]) & (ids != anchor["vec_id"]))
        at = at[_best(scores[at], ids[at], k)]
        return [(anchor["vec_id"], i, s) for i, s in zip(ids[at].tolist(), scores[at].tolist(), strict=True)]

    return choose


def _slots(k: int):
    def choose(anchor, scores, ids, labels):
        uppers = np.array(anchor["uppers"], np.int64)  # descending
        fits = (labels != anchor["label"]) & (scores <= uppers[0]) & (scores >= anchor["lowest"])
        at = np.flatnonzero(fits)
        # Slot j has the scores from its own upper limit down to, not including, the next one.
        slot = len(uppers) - 1 - np.searchsorted(uppers[::-1], scores[at])
        out = []
        for j in range(len(uppers)):
            own = at[slot == j]
            own = own[_best(scores[own], ids[own], k)]
            out += [
                (anchor["vec_id"], j, i, s)
                for i, s in zip(ids[own].tolist(), scores[own].tolist(), strict=True)
            ]
        return out

    return choose


def _blocks(rows: int, size: int, least: int) -> int:
    """Blocks of ``size`` rows at most, and some for every task."""
    return max(1, -(-rows // size), min(least, rows // 256))


class _Grid:
    """Rows in blocks; anchors meet all of them, a tile being a block of each."""

    def __init__(self, rows: DataFrame):
        self.rows, self.spark = rows, rows.sparkSession
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.n = _blocks(rows.count(), TILE_ROWS, tasks)

    def meet(self, anchors: DataFrame, choose, schema: str, fields: pa.Schema) -> DataFrame:
        """Per tile and anchor what ``choose`` picks. Anchors may have columns of their own."""
        m = _blocks(anchors.count(), TILE_ANCHORS, 1)
        more = [f for f in anchors.schema.fields if f.name not in self.rows.columns]

        def block(n: int) -> Column:
            return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")

        def every(n: int) -> Column:
            return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

        base = [F.col(c) for c in self.rows.columns]
        left = anchors.select(
            F.lit(0).alias("side"), block(m).alias("x"), every(self.n).alias("y"), *base,
            *[f.name for f in more],
        )
        right = self.rows.select(
            F.lit(1).alias("side"), every(m).alias("x"), block(self.n).alias("y"), *base,
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in more],
        )
        ship(self.spark)
        return left.unionByName(right).groupBy("x", "y").applyInArrow(_tile(choose, fields), schema)


def _leading(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best rows per key; all but k per task stay where they are."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """Hard negatives of the anchors among (``vec_id``, ``label``, ``vector`` of integers).

    An anchor's positives are the first ``positives`` other rows of its label, by inner
    product, ties by smaller id. For each, the result has the first ``negatives`` rows
    of other labels with ``low * positive_score <= 100 * negative_score <= high *
    positive_score`` (0 <= low <= high): ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``,
    ``positive_score``, ``negative_score``. Without a row in its window a positive has
    no row in the result; a score below zero has an empty window.

    The upper limits of an anchor's positives cut the scores into disjoint slots. A tile
    (a block of anchors, a block of rows) keeps the best rows of each slot, these are
    combined per anchor and slot, and what a window holds is the beginning of the slots
    from its own limit down. So a row is kept once per anchor however many windows hold
    it, and no label is a group.

    Rows with a NULL id, label, vector or component take no part. Of rows with one id
    the smallest by label and vector counts. A shorter vector is filled up with zeros;
    a product that is no long counts as the nearest one. Other columns are ignored; an
    empty table gives no row.
    """
    whole = F.forall("vector", lambda x: x.isNotNull())
    rows = rows.select("vec_id", F.col("label").cast("long").alias("label"), "vector").where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(whole, F.lit(False))
    )
    rows = settle(first_rows(rows, "vec_id"), "vectors")
    grid, anchors = _Grid(rows), rows.where(is_anchor)
    found = grid.meet(
        anchors,
        _positives(positives),
        "anchor_id long, vec_id long, score long",
        pa.schema([(c, pa.int64()) for c in ("anchor_id", "vec_id", "score")]),
    )
    found = settle(_leading(found, ["anchor_id"], positives), "positives")
    exact = "cast(score AS decimal(20,0))"
    limits = found.where("score >= 0").select(
        "anchor_id",
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
        F.expr(f"{exact} * {high} div 100").alias("upper"),
        F.expr(f"({exact} * {low} + 99) div 100").alias("lower"),
    )
    asked = limits.groupBy("anchor_id").agg(
        F.reverse(F.array_sort(F.collect_set("upper"))).alias("uppers"),
        F.min("lower").alias("lowest"),
    )
    slots = grid.meet(
        anchors.join(asked.withColumnRenamed("anchor_id", "vec_id"), "vec_id"),
        _slots(negatives),
        "anchor_id long, slot int, vec_id long, score long",
        pa.schema([
            ("anchor_id", pa.int64()), ("slot", pa.int32()), ("vec_id", pa.int64()),
            ("score", pa.int64()),
        ]),
    )
    # At most one entry per slot and rank.
    best = (
        _leading(slots, ["anchor_id", "slot"], negatives)
        .groupBy("anchor_id")
        .agg(F.array_sort(F.collect_list(F.struct("slot", "rank", "vec_id", "score"))).alias("best"))
    )
    slot = F.array_position("uppers", F.col("upper")) - 1
    below = F.filter("best", lambda x: x["slot"] >= F.col("slot"))
    window = F.filter(
        F.slice(below, 1, negatives), lambda x: x["score"] >= F.col("lower")
    )
    return (
        limits.join(asked, "anchor_id")
        .withColumn("slot", slot.cast("int"))
        .join(best, "anchor_id")
        .select("anchor_id", "positive_id", "positive_score", F.posexplode(window).alias("at", "row"))
        .select(
            "anchor_id",
            "positive_id",
            (F.col("at") + 1).alias("rank"),
            F.col("row.vec_id").alias("negative_id"),
            "positive_score",
            F.col("row.score").alias("negative_score"),
        )
    )


def negatives_table(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of every hundredth row, some labels being made wrong."""
    wrong = F.col("vec_id") % 7 == 0
    rows = embeddings.where(usable("embedding")).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(wrong, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("vector"),
    )
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)
