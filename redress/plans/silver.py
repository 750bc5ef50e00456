"""Cleaning and enrichment of the fact table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from redress.functions.dates import days_between, response_band, year_of
from redress.functions.text import digits, tag_array, upper_letters, valid_or_null
from redress.operators.aggregates import count_by
from redress.operators.relational import changed_rows, invalid_zips, order_desc

# Fixed value: a postal code is exactly five digits.
ZIP_PATTERN = "^[0-9]{5}$"


def clean(complaints: DataFrame) -> DataFrame:
    """Add zip_code_clean, state_clean, zip_valid and product_id_safe."""
    return complaints.withColumns({
        "zip_code_clean": digits(F.col("zip_code")),
        "state_clean": upper_letters(F.col("state")),
        "zip_valid": valid_or_null(digits(F.col("zip_code")), ZIP_PATTERN),
        "product_id_safe": F.col("product_id").try_cast("int"),
    })


def enrich(complaints: DataFrame) -> DataFrame:
    """Add response_days, response_band and year_received."""
    days = days_between(F.col("date_received"), F.col("date_sent_to_company"))
    return complaints.withColumns({
        "response_days": days,
        "response_band": response_band(days),
        "year_received": year_of(F.col("date_received")),
    })


def explode_tags(complaints: DataFrame) -> DataFrame:
    """One row per tag; a complaint without tags keeps one row with NULL."""
    return complaints.withColumn("tag_array", tag_array(F.col("tags"))).withColumn(
        "individual_tag", F.explode_outer("tag_array")
    )


def tag_counts(complaints: DataFrame) -> DataFrame:
    tags = explode_tags(complaints.select("tags"))
    return order_desc(count_by(tags, "individual_tag"), "count", "individual_tag")


def band_distribution(complaints: DataFrame) -> DataFrame:
    return order_desc(count_by(complaints, "response_band"), "count", "response_band")


def cleaning_report(complaints: DataFrame) -> dict[str, DataFrame]:
    """What cleaning did: changed zips, state pairs, zips found invalid."""
    return {
        "changed_zips": changed_rows(
            complaints.select("complaint_id", "zip_code", "zip_code_clean"),
            "zip_code",
            "zip_code_clean",
        ),
        "state_pairs": complaints.select("state", "state_clean").distinct(),
        "invalid_zips": invalid_zips(
            complaints.select("complaint_id", "zip_code", "zip_code_clean", "zip_valid")
        ),
    }
