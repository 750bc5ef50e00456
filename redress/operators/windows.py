"""Ranking within groups and running totals."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from redress.operators.joins import dim_join
from redress.sources.scratch import settle, shared_folder


def top_per_group(
    counts: DataFrame, group: str, value: str, k: int, rank_name: str = "rnk"
) -> DataFrame:
    """Rows whose rank by ``value`` within ``group`` is at most ``k``; ties stay.

    ``counts`` is stored first, because it is read twice. The rank of a row depends on its value alone, so the window runs over the
    distinct values of a group and not over its rows: a group with very many
    rows has few distinct counts, and equal rows never meet in one task. The
    at most ``k`` values left per group are then joined back to the rows.
    """
    counts = settle(counts, "counts")
    higher = (
        Window.partitionBy(group)
        .orderBy(F.desc("_value"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = (
        counts.groupBy(group, F.col(value).alias("_value"))
        .agg(F.count("*").alias("_rows"))
        .withColumn(rank_name, (F.coalesce(F.sum("_rows").over(higher), F.lit(0)) + 1).cast("int"))
        .where(F.col(rank_name) <= k)
        .select(group, "_value", rank_name)
    )
    return dim_join(counts, ranked, [group, (value, "_value")], "inner", null_safe=True)


def running_total(
    df: DataFrame, value: str, part: Column | str, order: str, name: str
) -> DataFrame:
    """Sum of ``value`` from the start of ``part`` up to the row's ``order``.

    Rows with equal ``order`` share one total (the default frame). Meant for
    aggregated input: all rows of one ``part`` meet in a task. For rows as they are
    there is ``running_total_of_rows``.
    """
    window = Window.partitionBy(part).orderBy(order)
    return df.withColumn(name, F.sum(value).over(window))


def running_total_of_rows(
    df: DataFrame, value: str, part: str, order: str, name: str
) -> DataFrame:
    """The same for a ``part`` of any number of rows: no task holds all rows of one.

    Rows are added up per (``part``, ``order``), within the tasks first, which also gives
    rows of equal ``order`` one total. These sums are range-partitioned and sorted; each
    partition runs its own total, and one offset per partition and part is added. The
    totals are joined back to the rows, hot keys being salted.
    """
    shared_folder(df.sparkSession)
    sums = df.groupBy(part, order).agg(F.sum(value).alias("_sum"))
    placed = (
        sums.repartitionByRange(part, order)
        .sortWithinPartitions(part, order)
        .checkpoint()
        .withColumn("_place", F.spark_partition_id())
    )
    within = Window.partitionBy(part, "_place").orderBy(order)
    before = Window.partitionBy(part).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part, "_place")
        .agg(F.sum("_sum").alias("_all"))
        .select(F.col(part).alias("_part"), "_place", F.sum("_all").over(before).alias("_before"))
    )
    own = placed.withColumn("_own", F.sum("_sum").over(within))
    total = F.coalesce(F.col("_own") + F.col("_before"), F.col("_own"), F.col("_before"))
    totals = dim_join(own, offsets, [(part, "_part"), "_place"], "left", null_safe=True).select(
        part, order, total.alias(name)
    )
    return dim_join(df, totals, [part, order], "left", null_safe=True)
