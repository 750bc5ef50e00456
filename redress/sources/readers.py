"""Scans of the raw feed and of stored tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from redress.sources.scratch import settle

# Quotes inside a quoted field are doubled, and a field may span lines.
CSV = {"header": True, "multiLine": True, "escape": '"'}


def read_raw(spark: SparkSession, path: str | list[str], infer: bool = False) -> DataFrame:
    """The raw feed with its original headers, every column a string.

    A file whose fields may span lines is read by one task, so the work spreads
    over files; small ones are packed together. For single huge files there is
    ``redress.sources.records.read_large_csv``. ``infer`` guesses types at the
    cost of one more pass.
    """
    return spark.read.options(**CSV, inferSchema=infer).csv(path)


def read_table(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """A CSV table - one file or a directory - with a fixed schema or inferred.

    ``multi_line=False`` splits large files over tasks; it is for tables whose
    text holds no line breaks, such as the dimensions.
    """
    reader = spark.read.options(**{**CSV, "multiLine": multi_line})
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


_WHOLE = r"^[+-]?[0-9]{1,19}$"
_REAL = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _typed(text: Column) -> dict[str, Column]:
    """The value of a text in each type that is tried, in order; NULL where it is none.

    Shapes are tested before the cast, because a failed cast costs an exception.
    """
    whole = F.when(text.rlike(_WHOLE), text)
    flag = F.lower(text)
    return {
        "int": whole.try_cast("int"),
        "bigint": whole.try_cast("bigint"),
        "double": F.when(text.rlike(_REAL), text).try_cast("double"),
        "date": F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text).try_cast("date"),
        "timestamp": F.when(
            text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}"), text
        ).try_cast("timestamp"),
        "boolean": F.when(flag == "true", True).when(flag == "false", False),
    }


def read_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A CSV table with types found from all its values; the files are parsed once.

    The all-string scan is stored, and one aggregate over it counts per column and type
    the values that are none. A column gets the first type, of int, bigint, double,
    date, timestamp and boolean, that fits every value; one without a value is text.
    """
    text = settle(read_raw(spark, path), "text", compression="zstd")
    columns = {c: _typed(F.col(f"`{c}`")) for c in text.columns}
    names = {(c, kind): f"{i}-{kind}" for i, c in enumerate(columns) for kind in columns[c]}
    misses = [
        F.count_if(F.col(f"`{c}`").isNotNull() & columns[c][kind].isNull()).alias(name)
        for (c, kind), name in names.items()
    ]
    filled = [F.count(f"`{c}`").alias(f"{i}-filled") for i, c in enumerate(columns)]
    seen = text.agg(*misses, *filled).first()
    chosen = []
    for i, (c, kinds) in enumerate(columns.items()):
        fits = [k for k in kinds if seen[names[c, k]] == 0] if seen[f"{i}-filled"] else []
        chosen.append((kinds[fits[0]] if fits else F.col(f"`{c}`")).alias(c))
    return text.select(chosen)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of few tasks one task per core; leave every other scan alone.

    A few files that cannot be split would keep all later steps in as many
    tasks. A scan with enough tasks is not shuffled. Only for plain scans:
    asking a plan with shuffles for its tasks would run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
