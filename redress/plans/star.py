"""Split of the flat feed into a fact and three dimensions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from redress.functions.dates import parse_date
from redress.functions.text import clean_name, yes_flag
from redress.operators.joins import BROADCAST_BYTES, ROW, fits_broadcast, lookup_id, meet_rows, numbered
from redress.operators.keys import assign_ids, distinct_keys
from redress.operators.relational import enforce
from redress.schema import COMPANIES, COMPLAINTS, ISSUES, PRODUCTS

PRODUCT_KEYS = ["product_name", "sub_product_name"]
ISSUE_KEYS = ["issue_name", "sub_issue_name"]


def build_products(raw: DataFrame) -> DataFrame:
    ids = assign_ids(distinct_keys(raw, PRODUCT_KEYS), PRODUCT_KEYS, "product_id")
    return enforce(ids, PRODUCTS)


def build_issues(raw: DataFrame) -> DataFrame:
    ids = assign_ids(distinct_keys(raw, ISSUE_KEYS), ISSUE_KEYS, "issue_id")
    return enforce(ids, ISSUES)


def build_companies(raw: DataFrame) -> DataFrame:
    names = raw.select(clean_name(F.col("company_name")).alias("company_name"))
    ids = assign_ids(distinct_keys(names, ["company_name"]), ["company_name"], "company_id")
    return enforce(ids, COMPANIES)


def fact_columns(df: DataFrame) -> DataFrame:
    """The 15 fact columns in order and type, dates and flags parsed."""
    return enforce(_parsed(df), COMPLAINTS)


def _parsed(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "date_received": parse_date(F.col("date_received")),
        "date_sent_to_company": parse_date(F.col("date_sent_to_company")),
        "timely_response": yes_flag(F.col("timely_response")),
        "consumer_disputed": yes_flag(F.col("consumer_disputed")),
    })


def build_fact(
    raw: DataFrame,
    products: DataFrame,
    issues: DataFrame,
    companies: DataFrame,
    null_safe: bool = True,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Replace the natural keys of the feed by surrogate ids.

    With dimensions that fit a broadcast this is one pass over the feed
    without a shuffle. If one does not, the rows move once, to that dimension, with dates
    and flags parsed and the other ids in place of their keys. Of several such only row
    numbers and keys go through the salted joins; the wide rows move once, to the ids
    that were found.
    """
    named = raw.withColumn("_clean", clean_name(F.col("company_name")))
    dims = (
        (products, PRODUCT_KEYS),
        (issues, ISSUE_KEYS),
        (companies, [("_clean", "company_name")]),
    )
    fits = [fits_broadcast(dim, limit) for dim, _ in dims]
    rows = named if all(fits) else numbered(named)
    keyed = _parsed(rows)
    alone = fits.count(False) == 1
    for small, (dim, keys) in sorted(zip(fits, dims, strict=True), key=lambda x: not x[0]):
        if small or alone:
            keyed = lookup_id(keyed, dim, keys, null_safe, limit, keys_of=named, salt=ROW)
            continue
        own = [k if isinstance(k, str) else k[0] for k in keys]
        found = lookup_id(
            rows.select(ROW, *own), dim, keys, null_safe, limit, keys_of=named, salt=ROW
        )
        keyed = meet_rows(keyed, found.drop(*own))
    return enforce(keyed, COMPLAINTS)


def build_star(
    raw: DataFrame, null_safe: bool = True, limit: int = BROADCAST_BYTES
) -> dict[str, DataFrame]:
    """products, issues, companies and complaints of one feed.

    ``raw`` is read four times, with few columns for the dimensions, so give
    it as Parquet. The ids are fixed when this returns: fact and dimensions
    always agree.
    """
    dims = {
        "products": build_products(raw),
        "issues": build_issues(raw),
        "companies": build_companies(raw),
    }
    return {**dims, "complaints": build_fact(raw, **dims, null_safe=null_safe, limit=limit)}
