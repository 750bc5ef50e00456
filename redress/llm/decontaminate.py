"""Benchmark decontamination with SimHash windows."""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from redress.llm.common import (
    map_batches,
    mix,
    shingle_hashes,
    slices,
    words_of,
)

SHINGLE = 5
SIMILARITY = 0.8
BITS = 64
#: Fingerprints of windows at the similarity limit differ in about 10 of 64 bits,
#: with a deviation of 3.
RADIUS = 22
#: Items that are sent to the tasks at once; more go in further passes.
ITEMS_AT_ONCE = 50_000


def _hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, the same within a process; items and texts meet in one."""
    return np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)


def _among(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values are in a sorted, non-empty table."""
    place = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[place] == values


def _signs(shingles: np.ndarray) -> np.ndarray:
    """One row of 64 votes, +1 or -1, per shingle."""
    bits = np.unpackbits(mix(shingles).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def _fingerprints(votes: np.ndarray) -> np.ndarray:
    """Rows of summed votes as 64-bit numbers."""
    return np.packbits(votes > 0, axis=1).view(np.uint64).ravel()


class BenchmarkIndex:
    """Items by number of words, their fingerprints in a multi-index of Hamming blocks.

    The 64 bits are cut into ``RADIUS + 1`` blocks. Two fingerprints within the
    radius agree in at least one block, whichever it is, so looking up every block
    finds all items within the radius.
    """

    def __init__(self, items: list[tuple[int, str]], similarity: float = SIMILARITY):
        self.similarity = similarity
        self.by_size: dict[int, dict] = {}
        known: list[np.ndarray] = []
        groups: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)
        for item, text in items:
            words = words_of(text)
            if words:
                shingles = shingle_hashes(_hashes(words), SHINGLE)
                groups[len(words)].append((item, shingles))
                known.append(shingles)
        self.known = np.unique(np.concatenate(known)) if known else np.empty(0, np.uint64)
        # The low 22 bits of known shingles, to pass over most others quickly.
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[(self.known & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        edges = [round(k * BITS / (RADIUS + 1)) for k in range(RADIUS + 2)]
        self.blocks = [
            (np.uint64(a), np.uint64((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:])
        ]
        for size, members in groups.items():
            prints = np.concatenate(
                [_fingerprints(_signs(s).sum(axis=0, keepdims=True)) for _, s in members]
            )
            index = []
            for shift, mask in self.blocks:
                values = (prints >> shift) & mask
                rows = np.argsort(values, kind="stable")
                index.append((values[rows], rows))
            self.by_size[size] = {
                "items": [item for item, _ in members],
                "weights": [Counter(s.tolist()) for _, s in members],
                "known": np.unique(np.concatenate([s for _, s in members])),
                "prints": prints,
                "index": index,
            }

    def _known(self, shingles: np.ndarray) -> np.ndarray:
        """Positions of shingles that some item has."""
        hit = self.sieve[(shingles & np.uint64((1 << 22) - 1)).astype(np.int64)]
        at = np.flatnonzero(hit)
        return at[_among(self.known, shingles[at])] if len(at) else at

    def search(self, text: str | None) -> dict[int, float]:
        """Items found in a text, with the best similarity of any window."""
        words = words_of(text)
        if not words or not self.by_size:
            return {}
        hashes = _hashes(words)
        found: dict[int, float] = {}
        long = shingle_hashes(hashes, SHINGLE) if len(words) >= SHINGLE else hashes[:0]
        hits = self._known(long)
        for size, group in self.by_size.items():
            if size < SHINGLE:
                if size > len(words):
                    continue
                shingles = shingle_hashes(hashes, size)
                starts = np.flatnonzero(_among(group["known"], shingles))
                ends = starts + 1
            elif not len(hits):
                continue
            else:
                shingles = long
                starts, ends = self._promising(long, hits, size - SHINGLE + 1, group)
            if len(starts):
                self._windows(shingles, starts, ends, group, found)
        return found

    def _promising(self, shingles, hits, width, group) -> tuple[np.ndarray, np.ndarray]:
        """Windows with as many of the group's shingles as the similarity asks for.

        A window of k shingles at the similarity s shares s (k + w) / (1 + s) of them
        with an item of w. Windows may hang over either end of the text, and then are
        the shorter for it; so a text may begin or end within an item, or be shorter.
        """
        own = hits[_among(group["known"], shingles[hits])]
        s, n = self.similarity, len(shingles)
        nothing = own[:0], own[:0]
        if min(n, len(own)) < s * width - 1e-9:
            return nothing
        before = np.zeros(n + 1, np.int64)
        before[own + 1] = 1
        before = np.cumsum(before)
        starts = np.arange(max(0, n - width + 1))
        lengths = np.arange(int(np.ceil(s * width - 1e-9)), min(width - 1, n) + 1)
        starts, ends = (
            np.concatenate(x)
            for x in ((starts, 0 * lengths, n - lengths), (starts + width, lengths, 0 * lengths + n))
        )
        need = s * (ends - starts + width) / (1 + s) - 1e-9
        at = np.flatnonzero(before[ends] - before[starts] >= need)
        at = at[np.argsort(starts[at], kind="stable")]
        return starts[at], ends[at]

    def _windows(self, shingles, starts, ends, group, found) -> None:
        low, most = 0, max(1, min(4096, 1_000_000 // len(group["items"])))
        while low < len(starts):
            # Windows that begin within a bounded stretch share their running sums.
            high = min(int(np.searchsorted(starts, starts[low] + 4096)), low + most)
            part, stop, low = starts[low:high], ends[low:high], high
            first, last = part[0], stop.max()
            sums = np.zeros((last - first + 1, BITS), np.int32)
            np.cumsum(_signs(shingles[first:last]), axis=0, out=sums[1:])
            prints = _fingerprints(sums[stop - first] - sums[part - first])
            windows, items = self._near(prints, group)
            seen: dict[int, Counter] = {}
            for w, i in zip(windows.tolist(), items.tolist(), strict=True):
                if w not in seen:
                    seen[w] = Counter(shingles[part[w] : stop[w]].tolist())
                score = weighted_similarity(seen[w], group["weights"][i])
                item = group["items"][i]
                if score >= self.similarity and score > found.get(item, 0.0):
                    found[item] = score

    def _near(self, prints: np.ndarray, group: dict) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of windows and items within the radius, looked up block by block."""
        n = len(group["items"])
        pairs = []
        for (values, rows), (shift, mask) in zip(group["index"], self.blocks, strict=True):
            own = (prints >> shift) & mask
            low, high = np.searchsorted(values, own), np.searchsorted(values, own, "right")
            sizes = high - low
            window = np.repeat(np.arange(len(prints)), sizes)
            offset = np.arange(len(window)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            pairs.append(window * n + rows[np.repeat(low, sizes) + offset])
        window, item = np.divmod(np.unique(np.concatenate(pairs)), n)
        close = np.bitwise_count(prints[window] ^ group["prints"][item]) <= RADIUS
        return window[close], item[close]


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Sum of the smaller over sum of the larger counts of all shingles."""
    common = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return common / (a.total() + b.total() - common)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """Pairs of a document row and a benchmark item found in it: ids and ``similarity``.

    Windows as long as an item, in words (A-Z lower-cased), slide over each whole
    text, and over its ends: a text that is shorter than the item, or that begins or
    ends within it, is compared as far as it goes. A window whose five-word shingles could reach the similarity is
    fingerprinted, the items within the Hamming radius are looked up by blocks,
    and the weighted shingle similarity decides exactly. Items shorter than five
    words are one shingle. The benchmark is sent to the tasks in blocks of a fixed
    number of items; the documents are not shuffled.

    NULL, empty or blank texts and items match nothing. Repeated document rows give
    repeated pairs; items of one id count as one, the best similarity standing.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType),
        T.StructField(item_col, benchmark.schema[item_col].dataType),
        T.StructField("similarity", T.DoubleType()),
    ])
    pairs = None
    for items in _blocks(benchmark.select(item_col, item_text_col)):
        sent = spark.sparkContext.broadcast((uuid.uuid4().hex, items))
        part = texts.transform(map_batches, _search(sent, similarity, to_arrow_schema(schema)), schema)
        pairs = part if pairs is None else pairs.unionByName(part)
    if pairs is None:
        return spark.createDataFrame([], schema)
    return pairs


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """The items in lists of bounded length."""
    block: list[tuple] = []
    for row in items.toLocalIterator():
        if row[1] and row[1].strip():
            block.append((row[0], row[1]))
        if len(block) == ITEMS_AT_ONCE:
            yield block
            block = []
    if block:
        yield block


_indexes: dict[str, BenchmarkIndex] = {}


def _index(sent, similarity: float) -> BenchmarkIndex:
    """The index of a broadcast list, built once per Python worker."""
    name, items = sent.value
    if name not in _indexes:
        _indexes.clear()
        _indexes[name] = BenchmarkIndex(items, similarity)
    return _indexes[name]


def _search(sent, similarity: float, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(sent, similarity)
        for part in slices(batches):
            rows = [
                (doc, item, score)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1), strict=True)
                for item, score in sorted(index.search(text.as_py()).items())
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], field.type) for k, field in enumerate(schema)],
                schema=schema,
            )

    return run


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item, all columns as they are.

    The decision is made on each row's own text, so rows that share an id are
    judged one by one, and nothing is shuffled.
    """
    for items in _blocks(benchmark.select("item_id", "text")):
        sent = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, items))
        at = docs.columns.index(text_col)

        def run(batches, sent=sent, at=at):
            index = _index(sent, SIMILARITY)
            for part in slices(batches):
                clean = [not index.search(t.as_py()) for t in part.column(at)]
                yield part.filter(pa.array(clean, pa.bool_()))

        docs = docs.transform(map_batches, run, docs.schema)
    return docs


def leak_table(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find_leaks(docs.select("doc_id", "text"), benchmark)
