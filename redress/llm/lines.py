"""Line deduplication over a corpus, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from redress.llm.common import SPACES, lower_ascii, same_row, without
from redress.sources.scratch import settle

OUTPUT = ["n_lines", "n_dropped", "keep_runs", "kept_text"]


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def repeated_lines(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    min_documents: int,
    min_chars: int,
    keep_first: bool,
) -> DataFrame:
    """Positions of the lines to drop: id, hash of the text, position.

    A line travels as a 128-bit hash of its key. The hashes are partitioned by
    range together with the document, so that a line found in a third of all
    documents is spread over many tasks; within a task they are sorted by
    document and position, and the first line of each key in each document
    streams past a row number. The number of documents of a key is the number of
    these firsts, added up within the tasks before it is shuffled.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = docs.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(text).alias("_text"),
        F.posexplode(F.split(text, "\n", -1)).alias("_pos", "_line"),
    ).withColumn("_key", line_key(F.col("_line")))
    hashes = lines.where(F.length("_key") >= max(1, min_chars)).select(
        F.xxhash64("_key").alias("_a"),
        F.xxhash64(F.lit(1), "_key").alias("_b"),
        "_id",
        "_text",
        "_pos",
    )
    order = ["_a", "_b", "_id", "_text", "_pos"]
    ranged = hashes.repartitionByRange("_a", "_b", "_id").sortWithinPartitions(*order)
    within = Window.partitionBy("_a", "_b", "_id").orderBy("_text", "_pos")
    streamed = settle(
        ranged.withColumn("_first", F.row_number().over(within) == 1), "line-hashes"
    )
    aggregates = [F.count("*").alias("_documents")]
    if keep_first:
        aggregates.append(F.min(F.struct("_id", "_text", "_pos")).alias("_kept"))
    frequent = settle(
        streamed.where("_first")
        .groupBy("_a", "_b")
        .agg(*aggregates)
        .where(F.col("_documents") >= min_documents),
        "frequent-lines",
    )
    # With p shuffle tasks, no more than p keys have an even share of the rows. Their
    # lines are found where they are; the others are joined.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(frequent.where(F.col("_documents") >= max(1, streamed.count() // tasks)))
    keys = ["_a", "_b"]
    found = streamed.join(hot, keys).unionByName(
        streamed.join(hot, keys, "anti").join(frequent, keys)
    )
    if keep_first:
        found = found.where(~F.struct("_id", "_text", "_pos").eqNullSafe(F.col("_kept")))
    return found.select("_id", "_text", "_pos")


def keep_bitmaps(dropped: DataFrame) -> DataFrame:
    """One compressed bitmap per document: run lengths, kept and dropped in turns.

    ``[3, 1, 2, 4]`` keeps three lines, drops one, keeps two and drops four; all
    that follow stay.
    """
    at = dropped.groupBy("_id", "_text").agg(F.sort_array(F.collect_set("_pos")).alias("_at"))
    starts = F.filter("_at", lambda p, i: ~F.get("_at", i - 1).eqNullSafe(p - 1))
    ends = F.filter("_at", lambda p, i: ~F.get("_at", i + 1).eqNullSafe(p + 1))
    edges = at.select(
        "_id", "_text", F.size("_at").alias("_n"), starts.alias("_starts"), ends.alias("_ends")
    )
    runs = F.transform(
        "_starts",
        lambda s, i: F.array(
            s - F.coalesce(F.get("_ends", i - 1) + 1, F.lit(0)), F.get("_ends", i) - s + 1
        ),
    )
    return edges.select("_id", "_text", "_n", F.flatten(runs).alias("_runs"))


def apply_bitmap(text: Column, runs: Column) -> Column:
    """The text without the lines that the bitmap drops."""
    flags = F.flatten(F.transform(runs, lambda n, i: F.array_repeat(i % 2 == 0, n)))
    flagged = F.zip_with(
        F.split(text, "\n", -1), flags, lambda line, kept: F.struct(line.alias("l"), kept.alias("k"))
    )
    kept = F.filter(flagged, lambda x: x["l"].isNotNull() & F.coalesce(x["k"], F.lit(True)))
    return F.array_join(F.transform(kept, lambda x: x["l"]), "\n")


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_documents: int = 10,
    min_chars: int = 1,
    keep_first: bool = False,
) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped``, ``keep_runs`` and ``kept_text``.

    The key of a line is the line without outer white space, A-Z in lower case.
    Keys of ``min_chars`` code points or more that are found in ``min_documents``
    documents or more lose all their lines in every document; with ``keep_first``,
    all but the first line, in order of ids (NULL first), texts and positions.

    NULL or empty text: one empty line, kept. Rows with one id (NULL is an id
    too) are one document when documents are counted, but each row keeps its own
    lines; equal rows get equal results. A column of the input named like a
    result is replaced; other columns pass through. An empty table stays empty.
    """
    docs = without(docs, OUTPUT)
    keys = docs.withColumns({
        "_id": F.col(id_col),
        "_text": F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))),
    })
    bitmaps = keep_bitmaps(
        repeated_lines(docs, id_col, text_col, min_documents, min_chars, keep_first)
    )
    text = F.coalesce(docs[text_col], F.lit(""))
    joined = keys.join(bitmaps, same_row(keys, bitmaps, ["_id", "_text"]), "left")
    line_count = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    runs = bitmaps["_runs"]
    return joined.select(
        *[docs[c] for c in docs.columns],
        line_count.cast("long").alias("n_lines"),
        F.coalesce(bitmaps["_n"], F.lit(0)).cast("long").alias("n_dropped"),
        runs.alias("keep_runs"),
        F.when(runs.isNull(), text).otherwise(apply_bitmap(text, runs)).alias("kept_text"),
    )


def line_dedup_digest(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )
