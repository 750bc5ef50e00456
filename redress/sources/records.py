"""Scan of quoted CSV files in parallel, however large they are.

A quoted field may hold line breaks, so a reader that starts in the middle of a
file cannot tell a record end from a line break inside a field, and Spark gives
each such file to one task. Here a file is read as lines, in splits as usual. A
line has a two-state effect: whether a record ends with it if it starts between
records, and whether one does if it starts inside a quoted field. Both follow
from the line alone, stray quotes included, since a quote opens a field only at
its start. Effects compose, so one small row per split tells how every split
starts. A second pass over the file then carries the state through each split in
order. Text is neither shuffled nor stored; only the pieces of records that cross
a split boundary are brought together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from redress.schema import all_strings
from redress.sources.readers import CSV
from redress.sources.workers import map_batches

# A field: a quoted part with doubled quotes and anything up to the comma, or no
# quote at its start. Possessive, so that long texts cannot exhaust the stack.
REST = r'(?:[^"]++|"")*+"[^,]*+'
FIELD = f'(?:"{REST}|[^",][^,]*+|)'
_ENDS_OUTSIDE = f"(?s)^{FIELD}(?:,{FIELD})*+$"
_ENDS_INSIDE = f"(?s)^{REST}(?:,{FIELD})*+$"
_WHOLE, _FIRST, _NEXT = 0, 1, 2


def read_large_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    header: bool = True,
) -> DataFrame:
    """The rows ``read_raw`` (or ``read_table`` with ``schema``) gives, read in splits."""
    if schema is None:
        schema = all_strings(spark.read.options(**{**CSV, "header": header}).csv(path).schema)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv(F.col("record"), ddl, {"escape": '"'})
    return csv_records(spark, path, header).select(parsed.alias("row")).select("row.*")


def csv_records(
    spark: SparkSession, path: str | list[str], header: bool = True, blank: bool = False
) -> DataFrame:
    """One column, ``record``: the records of CSV files as text, the header left out.

    Records are separated by ``\\n``, with or without ``\\r`` before it. Blank ones are
    left out, also before the header, unless ``blank`` is set; then each is a
    record, and the first record is the header whatever it holds. A quoted field
    that is never closed reaches to the end of its file. Both passes must cut the
    files alike; if the settings for splits change in between, the scan fails.
    """
    lines = _lines(spark, path)
    starts = _split_starts(lines, header, blank)
    known = spark.sparkContext.broadcast(
        {(r.file, r.split): (r.inside, r.heads) for r in starts.toLocalIterator()}
    )
    columns = "file long, split long, kind int, heads boolean, record string"
    whole = map_batches(lines, _records(known, blank, False), columns).select("record")
    # A record of several splits: its first piece and all that follow up to the next one.
    pieces = map_batches(lines, _records(known, blank, True), columns)
    return whole.unionByName(_joined(pieces))


def _lines(spark: SparkSession, path) -> DataFrame:
    value = F.col("value")
    plain = ~F.contains(value, F.lit('"'))
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            # A number instead of the name, which would be longer than most lines.
            F.xxhash64("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            (plain | value.rlike(_ENDS_OUTSIDE)).alias("outside_out"),
            (~plain & value.rlike(_ENDS_INSIDE)).alias("inside_out"),
            value.isin("", "\r").alias("empty"),
            "value",
        )
    )


def _states(outside_out: np.ndarray, inside_out: np.ndarray, inside: bool) -> np.ndarray:
    """For each line and one more: whether it starts inside a quoted field.

    Line effects are constant, identity or flip: the state is that of the last
    constant line, flipped once for each flip since.
    """
    n = len(outside_out)
    constant = outside_out == inside_out
    flips = np.concatenate([[0], np.cumsum(~outside_out & inside_out)])
    last = np.concatenate([[0], np.where(constant, np.arange(1, n + 1), 0)])
    last = np.maximum.accumulate(last)
    value = np.concatenate([[inside], ~outside_out])
    return value[last] ^ ((flips - flips[last]) % 2 == 1)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """Batches cut where another split begins; a task reads its splits one by one."""
    for batch in batches:
        splits = batch.column("split").to_numpy()
        files = batch.column("file").to_numpy()
        edges = np.flatnonzero((np.diff(splits) != 0) | (np.diff(files) != 0)) + 1
        for low, high in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            if high > low:
                part = batch.slice(low, high - low)
                yield (int(files[low]), int(splits[low])), part


def _flags(part: pa.RecordBatch) -> list[np.ndarray]:
    return [
        part.column(c).to_numpy(zero_copy_only=False) for c in ("outside_out", "inside_out", "empty")
    ]


def _effects(blank: bool):
    """One row per split: how it ends from either state, and whether a record begins in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits: dict[tuple[int, int], list] = {}
        for key, part in _runs(batches):
            outside_out, inside_out, empty = _flags(part)
            own = splits.setdefault(key, [False, True, False, False])
            for start in (0, 1):
                states = _states(outside_out, inside_out, own[start])
                own[start] = bool(states[-1])
                own[2 + start] |= bool((~states[:-1] & (blank | ~empty)).any())
        rows = [(*key, *own) for key, own in splits.items()]
        names = ["file", "split", "from_outside", "from_inside", "begins_outside", "begins_inside"]
        kinds = [pa.int64(), pa.int64(), *[pa.bool_()] * 4]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names
        )

    return run


def _split_starts(lines: DataFrame, header: bool, blank: bool) -> DataFrame:
    """file, split, inside (how it starts), heads (the file's header begins in it)."""
    effects = map_batches(
        lines.drop("value"),
        _effects(blank),
        "file long, split long, from_outside boolean, from_inside boolean, "
        "begins_outside boolean, begins_inside boolean",
    )
    before = Window.partitionBy("file").orderBy("split").rowsBetween(
        Window.unboundedPreceding, -1
    )
    constant = F.col("from_outside") == F.col("from_inside")
    flip = (F.col("from_outside") & ~F.col("from_inside")).cast("int")
    placed = effects.withColumns({
        "_flips": F.coalesce(F.sum(flip).over(before), F.lit(0)),
        "_all": F.coalesce(F.sum(flip).over(Window.partitionBy("file").orderBy("split")), F.lit(0)),
    }).withColumn(
        "_last",
        F.last(F.when(constant, F.struct("from_outside", "_all")), ignorenulls=True).over(before),
    )
    inside = F.coalesce(F.col("_last.from_outside"), F.lit(False)) != (
        (F.col("_flips") - F.coalesce(F.col("_last._all"), F.lit(0))) % 2 == 1
    )
    begins = F.when(F.col("inside"), F.col("begins_inside")).otherwise(F.col("begins_outside"))
    started = placed.withColumn("inside", inside)
    earlier = F.coalesce(F.max(begins.cast("int")).over(before), F.lit(0))
    heads = begins & (earlier == 0) if header else F.lit(False)
    return started.select("file", "split", "inside", heads.alias("heads"))


_PIECES = ["file", "split", "kind", "heads", "record"]


def _piece(current: tuple[int, int], kind: int, heads: bool, lines: list[str]) -> pa.RecordBatch:
    text = "\n".join(lines)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([current[0]], pa.int64()), pa.array([current[1]], pa.int64()),
            pa.array([kind], pa.int32()), pa.array([heads], pa.bool_()),
            pa.array([text.removesuffix("\r") if kind == _WHOLE else text], pa.string()),
        ],
        names=_PIECES,
    )


def _whole_records(part: pa.RecordBatch, first: np.ndarray, end: int, kept: np.ndarray):
    """The records that begin at the lines ``first``, the last of them ending before ``end``.

    ``kept`` says which of them are wanted. The lines of all are joined in one call.
    """
    lines = part.column("value")
    n = int(kept.sum())
    if len(first) == end - first[0]:
        records = pc.filter(lines.slice(first[0], end - first[0]), pa.array(kept))
    else:
        offsets = pa.array(np.append(first, end).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, lines)
        records = pc.binary_join(lists if kept.all() else lists.filter(pa.array(kept)), "\n")
    return pa.RecordBatch.from_arrays(
        [
            pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
            pa.array(np.full(n, _WHOLE, np.int32)), pa.array(np.zeros(n, bool)),
            pc.replace_substring_regex(records, "\r$", ""),
        ],
        names=_PIECES,
    )


def _records(known, blank: bool, crossing: bool):
    """Lines -> records that lie within a split, or the pieces of those that do not.

    ``crossing`` asks for the pieces; only the lines at either end of a split are looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, inside, heads, kind, heads_held = None, False, False, _NEXT, False
        held: list[str] = []
        for key, part in _runs(batches):
            if key != current:
                if held and crossing:
                    yield _piece(current, kind, heads_held, held)
                held = []
                if key not in known.value:
                    raise RuntimeError("the splits of a file changed between two reads")
                current, (inside, heads) = key, known.value[key]
                kind, heads_held = _NEXT, False
            outside_out, inside_out, empty = _flags(part)
            states = _states(outside_out, inside_out, inside)
            starts, inside = ~states[:-1], bool(states[-1])
            first = np.flatnonzero(starts)
            # Lines before the first record belong to one that began earlier.
            lead = int(first[0]) if len(first) else part.num_rows
            if lead:
                held.extend(part.column("value").slice(0, lead).to_pylist())
                if len(first) or not inside:
                    kind = _WHOLE if kind == _FIRST else kind
                    if crossing == (kind != _WHOLE) and not (kind == _WHOLE and heads_held):
                        yield _piece(current, kind, heads_held, held)
                    held, kind, heads_held = [], _NEXT, False
            if not len(first):
                continue
            # The last record goes on where the part ends inside a quoted field.
            end = int(first[-1]) if inside else part.num_rows
            sizes = np.diff(np.append(first, part.num_rows))
            kept = np.full(len(first), True) if blank else ~((sizes == 1) & empty[first])
            header = np.flatnonzero(kept) if heads else ()
            if len(header):
                # The first record that begins in this split is the header.
                heads, heads_held = False, inside and header[0] == len(first) - 1
                kept[header[0]] = False
            whole = len(first) - inside
            if whole and not crossing and kept[:whole].any():
                yield _whole_records(part, first[:whole], end, kept[:whole])
            if inside:
                held, kind = part.column("value").slice(end).to_pylist(), _FIRST
        if held and crossing:
            yield _piece(current, kind, heads_held, held)

    return run


def _joined(pieces: DataFrame) -> DataFrame:
    """Records that cross splits, from their pieces; one per group.

    A group holds the pieces of one record, so it is as large as the record.
    """
    first = F.col("kind") == _FIRST
    # Pieces are two per split at most, so the window of a file stays small.
    upto = Window.partitionBy("file").orderBy("split", F.col("kind").desc())
    grouped = pieces.withColumn("_record", F.max(F.when(first, F.col("split"))).over(
        upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ))
    parts = F.array_sort(F.collect_list(F.struct("split", "record")))
    text = F.array_join(F.transform(parts, lambda p: p["record"]), "\n")
    return (
        grouped.groupBy("file", "_record")
        .agg(text.alias("record"), F.bool_or("heads").alias("heads"))
        .where(~F.col("heads"))
        .select(F.regexp_replace("record", "\r$", "").alias("record"))
    )
