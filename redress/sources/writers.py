"""Sinks, the bulk load, the catalog and checks of what was written.

When a sink has written its files, the shuffle files it wrote on the way are deleted.
"""

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from redress.schema import STAR
from redress.sources.readers import CSV, read_parquet, read_table
from redress.sources.scratch import freed_shuffles, settle

BATCH_ROWS = 10_000  # fixed value: rows per insert batch

#: Rows of a CSV file at most: a file whose fields may span lines is read by one task.
FILE_ROWS = 500_000

RECORD = "record"  # the text of a row that does not fit its schema

# Text goes out as it is: quotes doubled, outer spaces kept.
CSV_TEXT = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``."""
    with freed_shuffles(df.sparkSession):
        df.write.mode("overwrite").parquet(path)


def write_layout(
    df: DataFrame, path: str, by: list[str], order: list[str], replace_all: bool = True
) -> None:
    """Replace the table at ``path``, a folder per value of ``by``, rows sorted in its files.

    Rows are range-partitioned by ``by``, ``order`` and their hash, so a value that holds
    a large share of them spreads over tasks and files, and the statistics of a file's
    row groups are narrow ranges of ``order``. With ``replace_all=False`` only the values
    of ``by`` that ``df`` has are replaced; the other folders stay as they are.
    """
    places = [*by, *order]
    sorted_rows = df.repartitionByRange(*places, F.xxhash64(*df.columns)).sortWithinPartitions(*places)
    with freed_shuffles(df.sparkSession):
        (
            sorted_rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
            .partitionBy(*by)
            .parquet(path)
        )


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """Replace the CSV directory at ``path``; a file per task and ``FILE_ROWS`` rows.

    With ``files`` there are so many, of any size. Quotes are doubled and outer spaces
    kept, so the text reads back as it was.
    """
    out = df.write if files is None else df.repartition(files).write
    if files is None:
        out = out.option("maxRecordsPerFile", FILE_ROWS)
    with freed_shuffles(df.sparkSession):
        out.mode("overwrite").options(header=True, **CSV_TEXT).csv(path)


def write_lines(df: DataFrame, path: str) -> None:
    """Replace the text files at ``path``: a file per task and ``FILE_ROWS`` rows."""
    with freed_shuffles(df.sparkSession):
        df.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).text(path)


def stringify_dates(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def export_star(tables: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Each star table as a CSV directory with its columns in fixed order."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder.rstrip('/')}/{name}"
        write_csv(df.select(*STAR[name].names), paths[name])
    return paths


class Loaded(NamedTuple):
    """A bulk load: the stored table, its rejected rows and the count of either."""

    table: DataFrame
    rejects: DataFrame
    loaded: int
    rejected: int


def bulk_load(
    spark: SparkSession, path: str, schema: StructType, out: str, header: bool = True
) -> Loaded:
    """Load a CSV of a fixed schema into Parquet, and say what did not fit it.

    A row with too few or too many fields, or with a value that its column's type does
    not have, is rejected: no value turns NULL unseen. ``rejects`` has the columns as
    far as they could be read, and the row's text as ``record``. The files are read
    once, the counts are taken on the way; only a load with rejects reads them again, to
    store those. A file is read by one task, so the work spreads over files. Blank
    lines are no rows.
    """
    marked = StructType([*schema.fields, StructField(RECORD, StringType())])
    read = (
        spark.read.schema(marked)
        .options(**CSV, mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD)
        .option("header", header)
        .csv(path)
    )
    bad, seen = F.col(RECORD).isNotNull(), Observation()
    counted = read.observe(
        seen, F.count_if(~bad).alias("loaded"), F.count_if(bad).alias("rejected")
    )
    write_parquet(counted.where(~bad).drop(RECORD), out)
    counts = seen.get
    # Stored with all columns: a scan that leaves some out does not try their types.
    rejects = settle(read.where(bad), "rejects") if counts["rejected"] else None
    if rejects is None:
        rejects = spark.createDataFrame([], marked)
    return Loaded(read_parquet(spark, out), rejects, counts["loaded"], counts["rejected"])


def load_dim(spark: SparkSession, path: str, schema: StructType, out: str) -> DataFrame:
    """Bulk-load a dimension CSV into Parquet; returns the stored table."""
    return bulk_load(spark, path, schema, out).table


def load_fact(spark: SparkSession, path: str, schema: StructType, out: str) -> DataFrame:
    """Bulk-load the fact CSV into Parquet, after its dimensions."""
    return bulk_load(spark, path, schema, out).table


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    batch: int = BATCH_ROWS,
    mode: str = "append",
    connections: int | None = None,
    **options: str,
) -> None:
    """Insert into a database table in batches of ``batch`` rows.

    Every task writes its rows in one transaction over its own connection;
    ``connections`` bounds how many there are. A task that is repeated after
    its commit inserts twice, so load into a table with a primary key, or into
    an empty staging table with mode 'overwrite' and count before the swap.
    """
    if connections is not None:
        options["numPartitions"] = str(connections)
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, batchsize=str(batch), **options)
        .mode(mode)
        .save()
    )


def register(tables: dict[str, DataFrame]) -> None:
    """Make the tables visible to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def list_views(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW VIEWS").select(F.col("viewName").alias("view_name"))


def fingerprint(df: DataFrame, empty_is_null: bool = False) -> DataFrame:
    """One row: ``row_count`` and sum and xor of a 64-bit hash per row.

    Equal for tables of the same rows in any order; one changed, swapped or missing
    value changes it. With ``empty_is_null`` an empty string counts as NULL, as a CSV
    file has it.
    """
    values = [
        F.nullif(F.col(f.name), F.lit(""))
        if empty_is_null and f.dataType.simpleString() == "string" else F.col(f.name)
        for f in df.schema.fields
    ]
    # A hash passes over NULLs, so whether a value is one is hashed beside it.
    row = F.xxhash64(*values, *[v.isNull() for v in values])
    return df.select(row.alias("_row")).agg(
        F.count("*").alias("row_count"),
        F.sum(F.col("_row").cast("decimal(38,0)")).alias("hash_sum"),
        F.bit_xor("_row").alias("hash_xor"),
    )


def verify_written(df: DataFrame, path: str, fmt: str) -> DataFrame:
    """One row: format, rows expected from ``df``, rows read back, all rows equal or not.

    The order of the rows does not matter; either side is read once.
    """
    spark = df.sparkSession
    back = read_parquet(spark, path) if fmt == "parquet" else read_table(spark, path, df.schema)
    sides = {"expected": df, "found": back.select(*df.columns)}
    both = reduce(
        DataFrame.unionByName,
        [fingerprint(side, fmt == "csv").withColumn("side", F.lit(name)) for name, side in sides.items()],
    )

    def of(side: str, column: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(column)))

    return both.agg(
        F.lit(fmt).alias("format"),
        *[of(side, "row_count").alias(side) for side in sides],
        *[
            of("expected", c).eqNullSafe(of("found", c)).alias(c)
            for c in ("row_count", "hash_sum", "hash_xor")
        ],
    ).select(
        "format", "expected", "found",
        (F.col("row_count") & F.col("hash_sum") & F.col("hash_xor")).alias("complete"),
    )


def storage_report(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Per label: files, bytes, and bytes relative to the smallest entry.

    Only file lengths are read, no content.
    """
    sizes = [
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
        .select(F.lit(label).alias("label"), "files", "bytes")
        for label, path in paths.items()
    ]
    report = reduce(DataFrame.unionByName, sizes)
    smallest = report.agg(F.nullif(F.min("bytes"), F.lit(0)).alias("smallest"))
    return report.withColumn(
        "times_smallest", F.round(F.col("bytes") / smallest.scalar(), 1)
    )
