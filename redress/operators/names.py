"""Audit of company-name variants.

``count_names`` is the one pass over the feed; the checks work on its stored
result, one row per name as written.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from redress.functions.text import case_key, punct_key, suffix_key
from redress.operators.aggregates import count_by, variant_groups
from redress.operators.relational import name_guard
from redress.sources.scratch import settle

CHECKS = {"case": case_key, "punct": punct_key, "suffix": suffix_key}


def count_names(raw: DataFrame, col: str = "company_name") -> DataFrame:
    """Complaints per company name, NULL and implausible names included."""
    return settle(count_by(raw, col, name="complaints"), "names")


def name_variants(names: DataFrame, check: str, col: str = "company_name") -> DataFrame:
    """Names that differ as written but meet under the key of ``check``.

    One row per name: key, number of variants of the key, name, complaints.
    Names without a key (nothing left but a legal form) are skipped.
    """
    keyed = name_guard(names, col).withColumn("name_key", CHECKS[check](F.col(col)))
    if check == "suffix":
        keyed = keyed.where(F.col("name_key") != "")
    return variant_groups(keyed, "name_key", col).select(
        "name_key", "variants", col, "complaints"
    )


def variant_summary(names: DataFrame, col: str = "company_name") -> DataFrame:
    """One row: total rows, raw names, groups per check, names after cleaning.

    Each name contributes one row per check, so that a single grouping serves
    all three.
    """
    usable = name_guard(names, col)
    total = names.agg(F.sum("complaints").alias("total_rows"))
    raw_names = usable.agg(F.count("*").alias("raw_names"))
    checks = [
        F.struct(F.lit(check).alias("check"), key(F.col(col)).alias("name_key"))
        for check, key in CHECKS.items()
    ]
    groups = (
        usable.select(F.inline(F.array(*checks)))
        .where((F.col("check") != "suffix") | (F.col("name_key") != ""))
        .groupBy("check", "name_key")
        .agg(F.count("*").alias("variants"))
        .groupBy("check")
        .agg(F.count("*").alias("keys"), F.count_if(F.col("variants") > 1).alias("groups"))
    )

    def of(check: str, value: str):
        return F.coalesce(F.max(F.when(F.col("check") == check, F.col(value))), F.lit(0))

    return (
        groups.agg(
            of("case", "groups").alias("case_groups"),
            of("punct", "groups").alias("punct_groups"),
            of("suffix", "groups").alias("suffix_groups"),
            of("case", "keys").alias("names_after_cleaning"),
        )
        .select(
            F.coalesce(total.scalar(), F.lit(0)).alias("total_rows"),
            raw_names.scalar().alias("raw_names"),
            "*",
        )
        .withColumn("merged_names", F.col("raw_names") - F.col("names_after_cleaning"))
    )
