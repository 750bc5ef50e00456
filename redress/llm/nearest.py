"""Approximate nearest neighbours: windows of several shifted Hilbert orderings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from redress.llm.common import map_batches
from redress.llm.vectors import first_rows, matrix, usable
from redress.sources.scratch import settle, shared_folder
from redress.sources.workers import ship

#: Orderings at most, at least; projected dimensions of each and bits of a dimension.
CURVES, LEAST_CURVES, DIMENSIONS, BITS = 8, 2, 16, 4
#: Distinct vectors drawn to centre the projections, and queries drawn to set the windows.
FIT_ROWS, FIT_QUERIES = 10_000, 256
#: Share of the drawn queries' true neighbours that the windows have to hold.
TARGET = 0.95
#: Positions to either side that a window has at least.
LEAST_WINDOW = 512
#: Positions of a block of rows, and of a block of queries, in a tile.
BLOCK, SPAN = 4096, 1 << 18
#: Scores that a task holds at a time.
TOGETHER = 4_000_000
#: A tile returns so many more than asked, for scores that rounding may have swapped.
SLACK = 8
_HALF = np.uint64(1 << 63)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position of each cell (a row of whole numbers below 2^bits) on the Hilbert curve.

    Rotations and reflections are undone from the highest bit down, a Gray code is
    resolved, and the bits of all dimensions are interleaved.
    """
    x = cells.astype(np.uint64).T.copy()
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit = np.uint64(1 << level)
        low = bit - one
        for i in range(len(x)):
            swapped = (x[0] ^ x[i]) & low
            reflect = (x[i] & bit) != 0
            x[0] ^= np.where(reflect, low, swapped)
            if i:
                x[i] ^= np.where(reflect, np.uint64(0), swapped)
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(level)) & one != 0, np.uint64((1 << level) - 1), 0)
    x ^= turn
    key = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for row in x:
            key = (key << one) | ((row >> np.uint64(level)) & one)
    return key


def projections(width: int, curves: int, seed: int = 7) -> list[np.ndarray]:
    """Orthogonal projections; those of one rotation share no direction while there are enough."""
    random, parts = np.random.default_rng(seed), []
    size = min(DIMENSIONS, width)
    while len(parts) < curves:
        turned = np.linalg.qr(random.normal(size=(width, width)))[0]
        parts += [turned[:, k : k + size] for k in range(0, width - size + 1, size)]
    return parts[:curves]


class Curves:
    """Projection, centre, scale and shift of every ordering, fitted on a sample.

    Inner products become distances on one sphere: a row is divided by the largest norm
    and gets one more component that fills it up to norm one, a query is divided by its
    own norm. The cells of a dimension span four deviations to either side, moved by a
    shift of up to half a cell of the coarsest grid that differs by curve and dimension.
    """

    def __init__(self, sample: np.ndarray, largest: float, width: int):
        self.largest, self.width = min(max(largest, 1e-150), 1e150), width
        self.parts = projections(width + 1, CURVES)
        random = np.random.default_rng(11)
        lifted = self.lift(sample, np.zeros(len(sample), bool))
        self.centres, self.scales = [], []
        for part in self.parts:
            cast = lifted @ part
            self.centres.append(cast.mean(axis=0))
            spread = cast.std(axis=0)
            self.scales.append(np.where(spread > 0, 8 * spread, 1.0))
        self.shifts = [random.uniform(-0.0625, 0.0625, p.shape[1]) for p in self.parts]

    def lift(self, vectors: np.ndarray, is_query: np.ndarray) -> np.ndarray:
        full = np.zeros((len(vectors), self.width))
        full[:, : vectors.shape[1]] = vectors[:, : self.width]
        full /= self.largest
        square = np.einsum("ij,ij->i", full, full)
        norm = np.sqrt(np.where(square > 0, square, 1.0))
        full[is_query] /= norm[is_query, None]
        rest = np.where(is_query, 0.0, np.sqrt(np.maximum(1.0 - square, 0.0)))
        return np.column_stack([full, rest])

    def keys(self, vectors: np.ndarray, is_query: np.ndarray) -> np.ndarray:
        """The signed 64-bit key of each vector on each curve, in the order of the curve."""
        lifted, out = self.lift(vectors, is_query), []
        for part, centre, scale, shift in zip(
            self.parts, self.centres, self.scales, self.shifts, strict=True
        ):
            place = (lifted @ part - centre) / scale + 0.5 + shift
            cells = np.clip(place * (1 << BITS), 0, (1 << BITS) - 1)
            out.append((hilbert_keys(cells.astype(np.int64), BITS) ^ _HALF).view(np.int64))
        return np.stack(out, axis=1)


def _keyed(curves: Broadcast):
    """point, is_query, vector -> curve, key, point, is_query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            is_query = batch.column(1).to_numpy(zero_copy_only=False)
            keys = curves.value.keys(matrix(batch.column(2)), is_query)
            n = keys.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.tile(np.arange(n, dtype=np.int32), len(keys))),
                    pa.array(keys.ravel()),
                    pa.array(np.repeat(batch.column(0).to_numpy(), n)),
                    pa.array(np.repeat(is_query, n)),
                ],
                names=["curve", "key", "point", "is_query"],
            )

    return run


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows, summed component by component in order."""
    total = np.zeros(len(queries))
    for k in range(min(queries.shape[1], rows.shape[1])):
        total += queries[:, k] * rows[:, k]
    return total


def _rank(scores: np.ndarray) -> np.ndarray:
    return np.where(np.isnan(scores), -np.inf, scores)


def _best(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, near=None):
    """For each query: the k best rows (ids ascending) by score, ties by id.

    ``near`` (low and high positions per query) says which rows may be found.
    """
    width = max(queries.shape[1], rows.shape[1])
    queries, rows = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (queries, rows))
    step = max(1, TOGETHER // max(1, len(rows)))
    for start in range(0, len(queries), step):
        part = queries[start : start + step]
        with np.errstate(all="ignore"):
            scores = _rank(part @ rows.T)
        for i, own in enumerate(scores, start):
            low, high = (0, len(rows)) if near is None else (near[0][i], near[1][i])
            own = own[low:high]
            most = min(len(own), k + SLACK)
            if not most:
                continue
            least = np.partition(own, len(own) - most)[len(own) - most]
            # Rows as good as the last one but for rounding stay; more than a few are ties.
            at = low + np.flatnonzero(own >= least - 1e-9 * abs(least) if np.isfinite(least) else own >= least)
            with np.errstate(all="ignore"):
                exact = _rank(_scores(np.broadcast_to(queries[i], (len(at), width)), rows[at]))
            order = np.lexsort((ids[at], -exact))[:k]
            yield i, ids[at[order]], exact[order]


def _search(k: int, window: int):
    """A block of rows and a block of queries of one curve -> the best in each window."""

    def run(table: pa.Table) -> pa.Table:
        is_query = table.column("is_query").to_numpy()
        rows = table.filter(pa.array(~is_query)).sort_by("position")
        asked = table.filter(pa.array(is_query)).combine_chunks()
        out: list[tuple] = []
        if rows.num_rows and asked.num_rows:
            positions = rows.column("position").to_numpy()
            at, points = asked.column("position").to_numpy(), asked.column("point").to_numpy()
            near = (
                np.searchsorted(positions, at - window),
                np.searchsorted(positions, at + window, "right"),
            )
            found = _best(
                matrix(asked.column("vector")), matrix(rows.column("vector")),
                rows.column("point").to_numpy(), k, near,
            )
            out = [(points[i], ids, scores) for i, ids, scores in found]
        lengths = [len(x[1]) for x in out]
        return pa.table({
            "query": pa.array(np.repeat(np.array([x[0] for x in out], np.int64), lengths)),
            "point": pa.array(np.concatenate([x[1] for x in out]) if out else [], pa.int64()),
            "score": pa.array(np.concatenate([x[2] for x in out]) if out else [], pa.float64()),
        })

    return run


def _truth(drawn: Broadcast, k: int):
    """point, vector -> for each drawn query the best rows of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = drawn.value[1]
        for batch in batches:
            order = np.argsort(batch.column(0).to_numpy(), kind="stable")
            ids, rows = batch.column(0).to_numpy()[order], matrix(batch.column(1))[order]
            for i, own, scores in _best(queries, rows, ids, k):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(own), drawn.value[0][i])), pa.array(own),
                        pa.array(scores),
                    ],
                    names=["query", "point", "score"],
                )

    return run


def _leading(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query; all but k per task stay where they are."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "point")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


class Index:
    """All distinct vectors as points on the curves, and the queries among them.

    A point is a distinct vector, named by its smallest id; so copies are one point
    however many there are, and equal scores are in the order of ids.
    """

    def __init__(self, rows: DataFrame, is_query: Column):
        self.spark = rows.sparkSession
        shared_folder(self.spark)
        ship(self.spark)
        kept = first_rows(rows.select("vec_id", "vector"), "vec_id")
        self.rows = settle(kept.withColumn("is_query", is_query), "vectors")
        self.points = settle(
            self.rows.groupBy("vector").agg(
                F.min("vec_id").alias("point"), F.max("is_query").alias("asked")
            ),
            "points",
        )
        self.count = self.points.count()

    def drawn(self, points: DataFrame, rows: int) -> pa.Table:
        """About so many of the points (all, if there are fewer), by the hash of their ids."""
        share = min(1.0, rows / max(1, points.count()))
        number = F.pmod(F.xxhash64("point"), F.lit(1 << 40))
        return points.where(number < int(share * (1 << 40))).toArrow()

    def fit(self) -> Broadcast:
        """Curves of a sample of about ``FIT_ROWS`` vectors."""
        square = F.aggregate(
            "vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")
        )
        largest, width = self.points.agg(F.max(F.sqrt(square)), F.max(F.size("vector"))).first()
        sample = matrix(self.drawn(self.points, FIT_ROWS).column("vector"), width=width or 0)
        return self.spark.sparkContext.broadcast(Curves(sample, largest or 1.0, width or 1))

    def order(self, curves: Broadcast) -> DataFrame:
        """``curve``, ``position``, ``point``, ``is_query``: the places on each curve."""
        both = self.points.select("point", F.lit(False).alias("is_query"), "vector").unionByName(
            self.points.where("asked").select("point", F.lit(True).alias("is_query"), "vector")
        )
        keyed = both.transform(
            map_batches, _keyed(curves), "curve int, key long, point long, is_query boolean"
        )
        keyed = settle(keyed, "curve-keys")
        spread = ["curve", "key", "point", "is_query"]
        placed = (
            keyed.repartitionByRange(*spread)
            .sortWithinPartitions(*spread)
            .select("curve", "point", "is_query")
            .checkpoint()
            .withColumn("_part", F.spark_partition_id())
            .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        )
        before = Window.partitionBy("curve").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (
            placed.groupBy("curve", "_part")
            .agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
            .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
            .select("curve", "_part", "_offset")
        )
        position = F.col("_row") + F.col("_offset")
        return settle(
            placed.join(F.broadcast(offsets), ["curve", "_part"]).select(
                "curve", position.alias("position"), "point", "is_query"
            ),
            "positions",
        )

    def window(self, places: DataFrame, k: int) -> tuple[int, int]:
        """Curves and positions to either side that hold ``TARGET`` of the true neighbours.

        About ``FIT_QUERIES`` drawn queries are compared with all points. Of the numbers of curves the one with the fewest positions to visit is
        taken. The windows of a small table hold all of it.
        """
        drawn = self.drawn(self.points.where("asked"), FIT_QUERIES)
        if not drawn.num_rows:
            return LEAST_CURVES, LEAST_WINDOW
        names = drawn.column("point").to_numpy()
        sent = self.spark.sparkContext.broadcast((names, matrix(drawn.column("vector"))))
        near = self.points.select("point", "vector").transform(
            map_batches, _truth(sent, k + 1), "query long, point long, score double"
        )
        near = _leading(near, k + 1).select("query", "point")
        near = settle(near.where("query <> point"), "neighbours")
        mine = places.where("is_query").select(
            "curve", F.col("point").alias("query"), F.col("position").alias("_at")
        )
        # The drawn queries and their neighbours are few by construction.
        gaps = (
            places.where("NOT is_query").join(F.broadcast(near), "point")
            .join(mine.join(F.broadcast(near.select("query").distinct()), "query"), ["curve", "query"])
            .groupBy("query", "point")
            .agg(F.array_sort(F.collect_list(
                F.struct("curve", F.abs(F.col("position") - F.col("_at")).alias("gap"))
            )).alias("gaps"))
        )
        found = gaps.select("gaps").toArrow().column("gaps").combine_chunks()
        if not len(found):
            return LEAST_CURVES, LEAST_WINDOW
        gap = found.flatten().field("gap").to_numpy().reshape(len(found), -1)
        best = []
        for curves in range(LEAST_CURVES, gap.shape[1] + 1):
            reach = int(np.quantile(gap[:, :curves].min(axis=1), TARGET, method="higher"))
            best.append((curves * max(reach, LEAST_WINDOW), curves, max(reach, LEAST_WINDOW)))
        return min(best)[1:]

    def search(self, k: int) -> DataFrame:
        """``query`` (a point), ``point``, ``score``, ``rank``: the best ``k`` points found."""
        places = self.order(self.fit())
        curves, window = self.window(places, k)
        placed = places.where(F.col("curve") < curves).join(
            self.points.select("point", "vector"), "point"
        )
        at = F.col("position")

        def blocks(low: Column, high: Column, size: int) -> Column:
            first = F.floor(F.greatest(low, F.lit(0)) / size)
            return F.explode(F.sequence(first, F.floor(high / size)))

        # A row stands in one block and meets the spans of queries that reach it.
        first, last = F.floor(at / BLOCK) * BLOCK, F.floor(at / BLOCK) * BLOCK + BLOCK - 1
        rows = placed.where("NOT is_query").select(
            "curve", F.floor(at / BLOCK).alias("block"), "position", "point", "is_query", "vector",
            blocks(first - window, last + window, SPAN).alias("span"),
        )
        asked = placed.where("is_query").select(
            "curve", blocks(at - window, at + window, BLOCK).alias("block"), "position", "point",
            "is_query", "vector", F.floor(at / SPAN).alias("span"),
        )
        tiles = rows.unionByName(asked).groupBy("curve", "block", "span")
        found = tiles.applyInArrow(_search(k, window), "query long, point long, score double")
        merged = found.groupBy("query", "point").agg(F.max("score").alias("score"))
        return _leading(merged, k)


def nearest(rows: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` largest inner products found.

    For every query among (``vec_id``, ``vector``) the nearest other rows, nearest first,
    ties by smaller id, scores summed in double precision in the order of the components.
    All rows are indexed and may be found; recall is set by ``TARGET`` on drawn queries
    and measured by the tests.

    Several Hilbert orderings of shifted projections are range-partitioned; a query meets
    the rows up to a window to either side of its place on each, in tiles of bounded size
    (a block of rows, a span of queries). Tiles return their best, which are merged and
    ranked by the exact scores. The window follows the data: see ``Index.window``.

    Equal vectors are one point, so a group of copies is one row on the curves; of a
    point only the first ``k + 1`` ids can be among the nearest, and only they are listed.
    NULL, zero and empty vectors and those with a NULL or non-finite component take no
    part, nor do rows without an id. Of rows with one id the smallest vector counts. A
    shorter vector is filled up with zeros. A product that is not a number ranks last, as
    minus infinity. Other columns are ignored; an empty table gives no row.
    """
    some = F.exists("vector", lambda x: x != 0)
    single = dict(rows.dtypes)["vector"] == "array<float>"
    rows = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("vector").cast("array<float>" if single else "array<double>").alias("vector"),
    ).where(F.col("vec_id").isNotNull() & usable("vector") & F.coalesce(some, F.lit(False)))
    index = Index(rows, is_query)
    found = settle(index.search(k + 1), "found")
    # The smallest ids of every point that was found; all but k + 1 per task stay there.
    copies = Window.partitionBy("vector").orderBy("vec_id")
    ids = index.rows.withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= k + 1)
    ids = ids.join(index.points.select("vector", "point"), "vector").select("point", "vec_id")
    near = found.join(ids, "point").select("query", "score", "vec_id")
    near = near.withColumn(
        "_rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    ).where(F.col("_rank") <= k + 1)
    # Every query has its point's list, less itself.
    queries = index.rows.where("is_query").join(index.points.select("vector", "point"), "vector")
    queries = queries.select(F.col("vec_id").alias("query_id"), F.col("point").alias("query"))
    lists = near.groupBy("query").agg(
        F.array_sort(F.collect_list(F.struct("_rank", "vec_id", "score"))).alias("_near")
    )
    others = F.filter("_near", lambda x: x["vec_id"] != F.col("query_id"))
    return (
        queries.join(lists, "query")
        .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("_at", "_row"))
        .select(
            "query_id", (F.col("_at") + 1).alias("rank"), F.col("_row.vec_id").alias("vec_id"),
            F.col("_row.score").alias("score"),
        )
    )


def nearest_table(embeddings: DataFrame) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    rows = embeddings.select("vec_id", F.col("embedding").alias("vector"))
    return nearest(rows, F.col("vec_id") % 20 == 0)
