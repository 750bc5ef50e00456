"""Data-quality audits: what a database would declare, as queries."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from redress.functions.text import is_blank
from redress.operators.aggregates import count_by
from redress.operators.joins import dim_join


def future_dates(complaints: DataFrame, as_of=None, col: str = "date_received") -> DataFrame:
    """Complaints received after ``as_of`` (today when not given)."""
    limit = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return complaints.where(F.col(col) > limit)


def illogical_dates(complaints: DataFrame) -> DataFrame:
    """Complaints sent to the company before they were received."""
    return complaints.where(F.col("date_sent_to_company") < F.col("date_received"))


def blank_names(dim: DataFrame, col: str) -> DataFrame:
    return dim.where(is_blank(F.col(col)))


def pk_violations(df: DataFrame, key: str) -> DataFrame:
    """Key values that are NULL or occur more than once, with their rows."""
    return count_by(df, key, name="rows", having=(F.col("rows") > 1) | F.col(key).isNull())


def fk_violations(complaints: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Foreign-key values that no dimension row has; NULL is allowed.

    ``dims`` maps key column -> dimension. The fact is read once: its keys are
    counted per (column, value) first, so only distinct values are looked up.
    """
    pairs = F.array(
        *[F.struct(F.lit(k).alias("fk"), F.col(k).cast("long").alias("value")) for k in dims]
    )
    used = (
        complaints.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("fk", "value")
        .agg(F.count("*").alias("rows"))
    )
    known = None
    for k, dim in dims.items():
        one = dim.select(F.lit(k).alias("fk"), F.col(k).cast("long").alias("value"))
        known = one if known is None else known.unionByName(one)
    return dim_join(used, known, ["fk", "value"], "left_anti")


def overlength(df: DataFrame, limits: dict[str, int], key: str) -> DataFrame:
    """Values longer than declared: row key, column, limit and actual length."""
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(n).alias("max_length"),
                F.length(c).alias("actual_length"),
            )
            for c, n in limits.items()
        ]
    )
    return df.select(key, F.inline(cells)).where(F.col("actual_length") > F.col("max_length"))


def zip_status(complaints: DataFrame) -> DataFrame:
    """How many postal codes are valid, and how many are not or missing."""
    status = F.when(F.col("zip_valid").isNotNull(), "Valid").otherwise("Invalid/Null")
    return count_by(complaints, status.alias("zip_status"))


def declared_lengths(
    tables: dict[str, DataFrame], limits: dict[str, dict[str, int]], keys: dict[str, str]
) -> DataFrame:
    """Values of a whole star that are longer than declared, with table and row key."""
    found = [
        overlength(tables[name], own, keys[name]).select(
            F.lit(name).alias("table_name"),
            F.col(keys[name]).cast("long").alias("key"),
            "column",
            "max_length",
            "actual_length",
        )
        for name, own in limits.items()
    ]
    return reduce(DataFrame.unionByName, found)


def unparsed(raw: DataFrame, parsers: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Non-blank texts that a parser turns into NULL: column, text, rows.

    ``parsers`` maps a column to the expression that reads it. Each text is counted
    once per column, before it is shuffled.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.when(~is_blank(F.col(c)) & parse(F.col(c)).isNull(), F.col(c)).alias("text"),
            )
            for c, parse in parsers.items()
        ]
    )
    return (
        raw.select(F.inline(cells))
        .where(F.col("text").isNotNull())
        .groupBy("column", "text")
        .agg(F.count("*").alias("rows"))
    )
