"""Distinct keys and dense surrogate ids."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from redress.sources.scratch import freed_shuffles, shared_folder

# monotonically_increasing_id(): partition number above bit 33, row number below.
_ROW_BITS = 33


def distinct_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).dropDuplicates()


def assign_ids(keys: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number ``keys`` 1..n in the order of ``order`` (NULLs first) as ``name``.

    The ids equal a row_number over the whole table, without bringing the
    table into one task: the keys are range-sorted and checkpointed, which
    fixes the rows of every partition; one count per partition gives the
    offset its row numbers start from. Only those counts - one row per
    partition - meet in a single task.
    """
    shared_folder(keys.sparkSession)
    pos = F.monotonically_increasing_id()
    with freed_shuffles(keys.sparkSession):
        stored = keys.orderBy(*order).checkpoint()
    placed = (
        stored
        .withColumn("_part", F.shiftright(pos, _ROW_BITS))
        .withColumn("_row", pos.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_row") + 1).cast("int").alias(name), *keys.columns
    )
