"""Projection, filter, sort, limit and report operators."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from redress.functions.text import safe_int


def canonicalize(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns by map; columns it does not name are left alone."""
    return df.withColumnsRenamed(mapping)


def enforce(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema`` in its order and types.

    A value its type cannot hold becomes NULL.
    """
    text = {name for name, kind in df.dtypes if kind == "string"}

    def typed(f: StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if f.name in text and isinstance(f.dataType, (IntegerType, LongType)):
            return safe_int(c, f.dataType.simpleString())
        return c.try_cast(f.dataType)

    return df.select([typed(f).alias(f.name) for f in schema.fields])


def schema_report(df: DataFrame) -> DataFrame:
    """Columns of ``df`` as rows: position, name, type, nullable."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column string, type string, nullable boolean"
    )


def name_guard(df: DataFrame, col: str, longest: int = 300) -> DataFrame:
    """Rows with a plausible name: present, not empty, not a stray narrative."""
    c = F.col(col)
    return df.where(c.isNotNull() & (F.length(c) <= longest) & (c != ""))


def changed_rows(df: DataFrame, before: str, after: str) -> DataFrame:
    """Rows whose two columns differ; a NULL on either side is no change."""
    return df.where(F.col(before) != F.col(after))


def invalid_zips(df: DataFrame) -> DataFrame:
    """Rows with a postal code that did not survive validation."""
    return df.where(F.col("zip_valid").isNull() & F.col("zip_code").isNotNull())


def order_desc(df: DataFrame, col: str, *tiebreak: str) -> DataFrame:
    return df.orderBy(F.desc(col), *tiebreak)


def top_k(df: DataFrame, by: str, k: int, *tiebreak: str | Column) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ``tiebreak`` makes the cut stable."""
    return df.orderBy(F.desc(by), *tiebreak).limit(k)


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows, for a look at the data."""
    return df.limit(n)


def first_groups(df: DataFrame, key: str, n: int = 25) -> tuple[DataFrame, DataFrame]:
    """Rows of the first ``n`` keys in key order, and how many keys remain."""
    keys = df.select(key).dropDuplicates()
    first = F.broadcast(keys.orderBy(key).limit(n))
    rows = df.join(first, df[key].eqNullSafe(first[key]), "left_semi")
    rest = keys.agg(F.greatest(F.count("*") - n, F.lit(0)).alias("remaining"))
    return rows, rest
