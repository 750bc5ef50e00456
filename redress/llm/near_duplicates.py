"""Near-duplicate documents: SuperMinHash, banding, verification, union-find."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from redress.llm.common import (
    MASK,
    Memo,
    map_batches,
    mix,
    shingle_hashes,
    slices,
    without,
    word_hashes,
    words_of,
)
from redress.llm.components import components
from redress.sources.scratch import settle

#: A pair at similarity 0.8 shares none of 54 bands with probability 3e-6, one at
#: 0.15 shares one with probability 1e-4.
BANDS, ROWS = 54, 7
SIGNATURE = BANDS * ROWS
#: Ids that are broadcast at most (8 bytes each).
BROADCAST_IDS = 1_000_000
#: Documents of a block of either side that a task compares, and shingles, about.
BLOCK, ELEMENTS = 512, 1 << 20
#: Rows of a key that may meet in one task whatever its share.
HOT = 1000
OUTPUT = ["n_shingles", "component_id", "kept"]
_EMPTY = np.uint64((1 << 64) - 1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, size: int, memo: Memo) -> np.ndarray:
    """Distinct hashed shingles of a text, sorted."""
    words = words_of(text)
    hashes = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    return np.unique(shingle_hashes(hashes, size))


def super_minhash(sets: list[np.ndarray], length: int = SIGNATURE) -> np.ndarray:
    """Signatures of non-empty sets, one row each.

    Every element has a random permutation of the components. In step j it offers
    the value j + r (r a random fraction) to the j-th component of its permutation,
    and a component keeps the least offer. An offer of a later step is greater than
    any of an earlier one, so a set is finished as soon as each component has had an
    offer: after about ``length * ln(length) / n`` steps for n elements. Values are
    64-bit numbers, the step above the fraction.
    """
    out = np.full((len(sets), length), _EMPTY)
    flat = out.ravel()
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    seeds = np.concatenate(sets)
    deal = None
    for step in range(length):
        random = mix(seeds + np.uint64((step + 1) * int(_STEP) & MASK))
        swap = step + ((random >> np.uint64(32)) % np.uint64(length - step)).astype(np.int64)
        if deal is None and step == 0:
            component, first = swap, swap
        else:
            if deal is None:
                # The permutations are needed from the second step on only.
                deal = np.tile(np.arange(length, dtype=np.int16), (len(seeds), 1))
                rows = np.arange(len(seeds))
                deal[rows, first] = 0
            component = deal[rows, swap].astype(np.int64)
            deal[rows, swap] = deal[rows, step]
        value = (np.uint64(step) << np.uint64(54)) | (mix(random) >> np.uint64(10))
        np.minimum.at(flat, owner * length + component, value)
        unfinished = (out == _EMPTY).any(axis=1)
        going = unfinished[owner]
        if not going.any():
            break
        if not going.all():
            owner, seeds = owner[going], seeds[going]
            if deal is not None:
                deal = deal[going]
                rows = np.arange(len(seeds))
            else:
                first = first[going]
    return out


def bands_of(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, different bands having different keys."""
    parts = signatures.reshape(len(signatures), BANDS, ROWS)
    keys = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for k in range(ROWS):
        keys = mix(keys * _STEP + parts[:, :, k])
    return keys


def _chunks(sets: list[np.ndarray], elements: int = 16_384) -> Iterator[list[int]]:
    """Positions of non-empty sets, together so many elements, sets of like size together."""
    chunk, total = [], 0
    for i in sorted(range(len(sets)), key=lambda i: len(sets[i])):
        s = sets[i]
        if len(s):
            if chunk and total + len(s) > elements:
                yield chunk
                chunk, total = [], 0
            chunk.append(i)
            total += len(s)
    if chunk:
        yield chunk


def _sketch(size: int):
    """id, text, its hash -> id, hash, number of shingles, digest of the set, band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_hashes()
        for part in slices(batches):
            sets = [shingle_set(t.as_py(), size, memo) for t in part.column(1)]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            keys: list[np.ndarray | None] = [None] * len(sets)
            for chunk in _chunks(sets):
                for i, row in zip(chunk, bands_of(super_minhash([sets[i] for i in chunk])), strict=True):
                    keys[i] = row.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["id", "text_hash", "n", "d1", "d2", "bands"],
            )

    return run


def _sets(size: int):
    """id, text -> id, number of shingles, digest of the set, the set itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_hashes()
        for part in slices(batches):
            sets = [shingle_set(t.as_py(), size, memo).tobytes() for t in part.column(1)]
            halves = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, sets)), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(halves[0::2]),
                    pa.array(halves[1::2]),
                    pa.array(sets, pa.binary()),
                ],
                names=["id", "d1", "d2", "shingles"],
            )

    return run


class _Unit:
    """The left side of a unit of work: documents that each one of the right side meets."""

    def __init__(self, name: tuple, percent: int):
        self.name, self.percent = name, percent
        self.left: list[dict] = []
        self.columns: tuple | None = None
        self.parent: dict[int, int] = {}

    def index(self) -> tuple:
        """The left side as columns, and which of its documents hold a shingle."""
        if self.columns is None:
            ids, components = (
                np.array([d[c] for d in self.left], np.int64) for c in ("id", "component")
            )
            sets = [np.frombuffer(d["shingles"], np.uint64) for d in self.left]
            bands = np.array([d["bands"] for d in self.left], np.int64)
            sizes = np.array(list(map(len, sets)), np.int64)
            values = np.concatenate(sets)
            order = np.argsort(values, kind="stable")
            holders = np.repeat(np.arange(len(sets)), sizes)[order]
            self.columns = ids, components, sizes, bands, values[order], holders
        return self.columns

    def find(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            x = up
        return x

    def meet(self, other: dict, key: int | None) -> Iterator[tuple[int, int]]:
        """Links of a document with those of the left side, as few as connect them.

        Only documents of different components meet, and where ``key`` is the band that
        the unit is about, only those that share no band before it: a pair has one
        bucket in which it is compared.
        """
        if not self.left:
            return
        ids, components, sizes, bands, values, holders = self.index()
        own = np.frombuffer(other["shingles"], np.uint64)
        low, high = np.minimum(sizes, len(own)), np.maximum(sizes, len(own))
        fits = (components != other["component"]) & (100 * low >= self.percent * high)
        if key is not None:
            if other["outsider"]:
                fits &= ids < other["id"]
            shared = bands == np.array(other["bands"], np.int64)
            band = other["bands"].index(key)
            fits &= shared[:, band] & ~shared[:, :band].any(axis=1)
        if not fits.any():
            return
        start = np.searchsorted(values, own)
        times = np.searchsorted(values, own, "right") - start
        at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        common = np.bincount(holders[np.repeat(start, times) + at], minlength=len(ids))
        fits &= (common > 0) & (100 * common >= self.percent * (sizes + len(own) - common))
        for i in np.flatnonzero(fits).tolist():
            x, y = self.find(int(components[i])), self.find(other["component"])
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                yield min(int(ids[i]), other["id"]), max(int(ids[i]), other["id"])


def _compare(percent: int, banded: bool):
    """Rows of units, each unit's left side first -> links between its sides.

    Units stand one after the other, so no more than a left side is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = None
        for part in slices(batches):
            links: list[tuple[int, int]] = []
            for row in part.to_pylist():
                name = (row["unit"], row["x"], row["y"])
                if unit is None or unit.name != name:
                    unit = _Unit(name, percent)
                if row["side"] == 0:
                    unit.left.append(row)
                else:
                    links += unit.meet(row, row["unit"] if banded else None)
            if links:
                columns = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["a", "b"]
                )

    return run


def _by_key(rows: DataFrame, info: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with ``info``, one row per key that says how many (``s``) it has.

    Keys with more than an even share of a task's rows, no more than there are tasks,
    are sent to all tasks, so their rows stay where they are.
    """
    info = settle(info, "keys")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = info.agg(F.sum("s")).first()[0] or 0
    share = max(HOT, total // tasks)
    hot = F.broadcast(info.where(F.col("s") > share))
    cold = rows.join(hot.select(key), key, "anti").join(info.where(F.col("s") <= share), key)
    return rows.join(hot, key).unionByName(cold)


class _Search:
    """Links among the members of band buckets, compared by their full sets.

    Rows are members of buckets, never pairs: a unit of work is a block of documents on
    either side, and its task returns as many links as connect what it finds.
    """

    def __init__(self, members: DataFrame, sets: DataFrame, percent: int):
        #: key, id, n (shingles), s (members of the bucket)
        self.members = members
        #: id, shingles, bands
        self.sets = sets
        self.percent = percent

    def compared(self, units: DataFrame, banded: bool) -> DataFrame:
        """The links that units (unit, x, y, side, id, component, outsider) find, stored."""
        place = ["unit", "x", "y"]
        whole = (
            units.join(self.sets, "id")
            .repartition(*place)
            .sortWithinPartitions(*place, "side", "id")
            .select(*place, "side", "id", "component", "outsider", "shingles", "bands")
        )
        links = whole.transform(map_batches, _compare(self.percent, banded), "a long, b long")
        return settle(links, "links")

    def _blocks(self, count: str, elements: str):
        """Blocks of at most ``BLOCK`` documents and ``ELEMENTS`` shingles, about."""
        most = F.greatest(F.col(count) / BLOCK, F.col(elements) / ELEMENTS)
        return F.greatest(F.ceil(most), F.lit(1)).cast("int")

    def hubs(self, members: DataFrame) -> DataFrame:
        """Links of each bucket's hub with its members of other components.

        The hub is the member with the largest buckets: of copies of one text with
        changes of their own, that text. Its members are dealt into blocks.
        """
        degree = members.groupBy("id").agg(F.sum("s").alias("degree"))
        info = (
            members.join(degree, "id")
            .groupBy("key")
            .agg(
                F.max(F.struct("degree", "id", "n", "component")).alias("hub"),
                F.count("*").alias("s"),
            )
        )
        low, high = F.least("n", "hub.n"), F.greatest("n", "hub.n")
        met = _by_key(members.drop("s"), info, "key").where(
            (F.col("component") != F.col("hub.component")) & (100 * low >= self.percent * high)
        )
        met = settle(
            met.select(
                F.col("hub.id").alias("unit"), F.col("hub.component").alias("_own"), "id",
                "component", "n",
            ).distinct(),
            "hub-members",
        )
        info = (
            met.groupBy("unit", "_own")
            .agg(F.count("*").alias("s"), F.sum("n").alias("e"))
            .withColumn("blocks", self._blocks("s", "e"))
        )
        no, zero = F.lit(False).alias("outsider"), F.lit(0)
        left = info.select(
            "unit", F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("x"), zero.alias("y"),
            zero.alias("side"), F.col("unit").alias("id"), F.col("_own").alias("component"), no,
        )
        right = _by_key(met.drop("_own"), info, "unit").select(
            "unit", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("x"),
            zero.alias("y"), F.lit(1).alias("side"), "id", "component", no,
        )
        return self.compared(left.unionByName(right), banded=False)

    def links(self) -> DataFrame:
        """Links that connect all that any chain of links among candidates connects.

        First each bucket's hub meets the others. What is linked then counts as one
        component, and only members of different components of a bucket still have to
        meet: once more by hubs if there are many, and then all that are left.
        """
        found = self.hubs(self.members)
        members = self.unsettled(components(found))
        pairs, rows = members.agg(F.sum("s") / 2, F.count("*")).first()
        if pairs and pairs > 2 * rows:
            found = settle(found.unionByName(self.hubs(members)), "links")
            members = self.unsettled(components(found))
        return settle(found.unionByName(self.rest(members)), "links")

    def unsettled(self, mapped: DataFrame) -> DataFrame:
        """Members of the buckets that hold several components, with ``main``, the largest."""
        joined = settle(
            self.members.select("key", "id", "n", "s")
            .join(mapped.withColumnRenamed("node", "id"), "id", "left")
            .withColumn("component", F.coalesce("component", "id")),
            "placed-members",
        )
        mixed = (
            joined.groupBy("key")
            .agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.max("s").alias("s"))
            .where("_low < _high")
            .select("key", "s")
        )
        held = settle(_by_key(joined.drop("s"), mixed, "key"), "mixed-members")
        main = (
            held.groupBy("key", "component")
            .agg(F.count("*").alias("c"), F.sum("n").alias("e"))
            .groupBy("key")
            .agg(
                F.max(F.struct("c", "component")).alias("_main"), F.sum("c").alias("s"),
                F.sum("e").alias("e"),
            )
            .select("key", F.col("_main.component").alias("main"), "s", "e")
        )
        return settle(_by_key(held.drop("s"), main, "key"), "band-members")

    def rest(self, members: DataFrame) -> DataFrame:
        """Links between all members of different components of a bucket.

        One of the two is outside the bucket's main component, so the left side are
        those, in blocks, and the right side all, in blocks; each left block meets each
        right one. A pair that shares several buckets is compared in one of them.
        """
        outside = F.col("component") != F.col("main")
        left = members.where(outside)
        blocks = (
            left.groupBy("key")
            .agg(F.count("*").alias("o"), F.sum("n").alias("oe"), F.max("s").alias("s"), F.max("e").alias("e"))
            .select("key", "s", self._blocks("o", "oe").alias("xs"), self._blocks("s", "e").alias("ys"))
        )
        dealt = settle(_by_key(members.drop("s", "e"), blocks, "key"), "dealt-members")

        def block(n: str):
            return F.pmod(F.xxhash64("id"), F.col(n)).cast("int")

        def every(n: str):
            return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

        both = ["id", "component", outside.alias("outsider")]
        unit = F.col("key").alias("unit")
        units = dealt.where(outside).select(
            unit, block("xs").alias("x"), every("ys").alias("y"), F.lit(0).alias("side"), *both
        ).unionByName(dealt.select(
            unit, every("xs").alias("x"), block("ys").alias("y"), F.lit(1).alias("side"), *both
        ))
        return self.compared(units, banded=True)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``docs`` with ``n_shingles``, ``component_id`` and ``kept``.

    Words are runs without white space, A-Z in lower case; a document is the set of
    its word shingles (a shorter one is a single shingle). Documents are linked if
    ``100 * intersection >= percent * union`` on the full sets. ``component_id`` is
    the smallest id reachable over links; that document is ``kept``.

    Equal sets are one node, so copies cost one row each however many there are.
    Signatures (SuperMinHash) are cut into bands; sets that share a band key are
    candidates, which are compared in full, in blocks within tasks.

    NULL, empty and blank texts have no shingle and are linked with nothing. Rows
    of one id are one node: what links one of them links all, and they share a
    component. Rows without an id stay apart: NULL component, kept. Ids are integers.
    Columns named like a result are replaced; an empty table stays empty.
    """
    docs = without(docs, OUTPUT)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    classes = duplicate_classes(rows, shingle_words, percent)
    # Rows of one id may have different texts, and so different sets.
    per_row = classes.select("id", "text_hash", "n", "component").distinct()
    keyed = docs.withColumns({
        "_id": F.col(id_col).cast("long"), "_text": F.xxhash64(F.col(text_col))
    })
    same = keyed["_id"].eqNullSafe(per_row["id"]) & (keyed["_text"] == per_row["text_hash"])
    return keyed.join(per_row, same, "left").select(
        *[keyed[c] for c in docs.columns],
        per_row["n"].alias("n_shingles"),
        per_row["component"].alias("component_id"),
        F.coalesce(per_row["component"] == keyed["_id"], F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(options.pop("text_col", "text")).alias("text")
    )
    classes = duplicate_classes(rows, options.get("shingle_words", 5), options.get("percent", 80))
    dropped = classes.where("component <> id").select(F.col("id").alias("_dropped")).distinct()
    return docs.join(dropped, docs[id_col] == dropped["_dropped"], "anti")


def _texts_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows (id, text) with these ids."""
    # Few ids are sent to the documents; else the documents are shuffled to them.
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return rows.select("id", "text").join(wanted, "id", "semi")


def duplicate_classes(rows: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """``id``, ``text_hash``, ``n``, ``component`` of each row of (id, text)."""
    sketches = settle(
        rows.select("id", "text", F.xxhash64("text").alias("text_hash")).transform(
            map_batches,
            _sketch(shingle_words),
            "id long, text_hash long, n long, d1 long, d2 long, bands array<long>",
        ),
        "sketches",
    )
    filled = sketches.where("n > 0 AND id IS NOT NULL")
    sets = settle(filled.groupBy("d1", "d2", "n").agg(F.min("id").alias("leader")), "sets")
    # Bands of one document per set: those of its leader.
    own = sets.withColumnRenamed("leader", "id")
    leaders = filled.join(own, ["id", "d1", "d2", "n"], "semi").dropDuplicates(["id", "d1", "d2"])
    leaders = settle(leaders.select("id", "d1", "d2", "n", "bands"), "leaders")
    keys = leaders.select("id", "n", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("s")).where("s > 1")
    members = settle(
        _by_key(keys, shared, "key").withColumn("component", F.col("id")), "band-members"
    )
    found = leaders.join(members.select("id").distinct(), "id", "semi")
    texts = _texts_of(rows, found.select("id").distinct())
    whole = texts.transform(
        map_batches, _sets(shingle_words), "id long, d1 long, d2 long, shingles binary"
    ).groupBy("id", "d1", "d2").agg(F.min("shingles").alias("shingles"))
    compared = settle(
        whole.join(found, ["id", "d1", "d2"]).select("id", "shingles", "bands"), "candidate-sets"
    )
    links = _Search(members, compared, percent).links()
    # An id whose rows have different texts ties their sets together.
    several = (
        filled.groupBy("id")
        .agg(F.min("d1").alias("l"), F.max("d1").alias("m"))
        .where("l < m")
        .select("id")
    )
    tied = (
        filled.join(several, "id", "semi")
        .join(sets, ["d1", "d2", "n"])
        .where("id <> leader")
        .select(F.col("id").alias("a"), F.col("leader").alias("b"))
    )
    mapped = components(links.unionByName(tied)).select(
        F.col("node").alias("leader"), "component"
    )
    placed = sets.join(mapped, "leader", "left").select(
        "d1", "d2", "n", F.coalesce("component", "leader").alias("component")
    )
    return (
        sketches.select("id", "text_hash", "n", "d1", "d2")
        .join(placed, ["d1", "d2", "n"], "left")
        .select(
            "id",
            "text_hash",
            "n",
            F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"),
        )
    )


def near_duplicate_table(docs: DataFrame) -> DataFrame:
    """Classes over two-word shingles, one row per document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    return duplicate_classes(rows, 2, 80).select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("component") == F.col("id"), F.lit(True)).alias("kept"),
    )
