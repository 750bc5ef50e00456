"""Grouped counts, rates and nested aggregates."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from redress.functions.rates import count_where, pct
from redress.operators.joins import dim_join


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and row count, sorted by name."""
    counted = None
    for name, df in tables.items():
        one = row_count(df).select(F.lit(name).alias("table_name"), "row_count")
        counted = one if counted is None else counted.unionByName(one)
    return counted.orderBy("table_name")


def count_by(
    df: DataFrame,
    keys: list[str | Column] | str | Column,
    col: str | None = None,
    name: str = "count",
    having: Column | None = None,
) -> DataFrame:
    """Rows per group, or non-NULL values of ``col`` per group.

    ``keys`` may be expressions; ``having`` filters on the aggregated columns.
    """
    keys = keys if isinstance(keys, list) else [keys]
    out = df.groupBy(*keys).agg(F.count(col or "*").alias(name))
    return out if having is None else out.where(having)


def mean_group_count(df: DataFrame, key: str, name: str = "mean_count") -> DataFrame:
    """Average group size; the group of NULL keys counts as one."""
    return count_by(df, key, name="_n").agg(F.avg("_n").alias(name))


def max_group_count(df: DataFrame, keys: list[str], name: str = "max_count") -> DataFrame:
    """Largest count of the last key within each group of the keys before it."""
    return count_by(df, keys, name="_n").groupBy(*keys[:-1]).agg(F.max("_n").alias(name))


def rate_by(
    df: DataFrame,
    key: str,
    cond: Column,
    total: Column | None = None,
    names: tuple[str, str, str] = ("total", "matching", "rate_pct"),
    min_n: int | None = None,
    min_pct: float | None = None,
    places: int = 2,
) -> DataFrame:
    """Per group: size, rows matching ``cond`` and their percentage.

    ``min_n`` and ``min_pct`` keep groups strictly above both. The percentage
    is compared before rounding, on whole numbers.
    """
    n_name, hit_name, pct_name = names
    out = df.groupBy(key).agg(
        (F.count("*") if total is None else total).alias(n_name),
        count_where(cond).alias(hit_name),
        F.count("*").alias("_rows"),
    )
    if min_n is not None:
        out = out.where(F.col(n_name) > min_n)
    if min_pct is not None:
        out = out.where(F.col(hit_name) * 100 > F.col("_rows") * min_pct)
    return out.withColumn(pct_name, pct(F.col(hit_name), F.col("_rows"), places)).drop("_rows")


def above_average(counts: DataFrame, value: str, mean: DataFrame) -> DataFrame:
    """Rows of ``counts`` whose ``value`` exceeds the one value in ``mean``."""
    return counts.where(F.col(value) > mean.scalar())


def variant_groups(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is shared by more than one distinct value.

    ``df`` holds each value once. One row per variant is returned rather than
    one list per key: a key may have any number of variants. The number of
    variants of the key comes along as ``variants``.
    """
    shared = (
        df.groupBy(key)
        .agg(F.count(value).alias("variants"))
        .where(F.col("variants") > 1)
    )
    return dim_join(df, shared, [key], "inner")
