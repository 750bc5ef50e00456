"""The KPI pack over a star of products, issues, companies and complaints.

Counts are taken per surrogate id first and only then joined to names: the
fact is scanned once for the few columns a KPI needs, combined map-side, and
never joined row by row. Names shared by several ids (a product name with many
sub-products) are summed after the join.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from redress.functions.dates import month_key, month_start
from redress.functions.rates import count_where, pct, tier
from redress.operators.aggregates import above_average, count_by, rate_by
from redress.operators.joins import BROADCAST_BYTES, denormalize
from redress.operators.relational import order_desc, top_k
from redress.operators.windows import running_total, top_per_group
from redress.sources.scratch import settle

Star = dict[str, DataFrame]

# Company volume tiers, lowest count -> label.
VOLUME_TIERS = ((10000, "Critical"), (1000, "High"), (100, "Medium"))
LOWEST_TIER = "Low"

_DIMS = {
    "product_id": ("products", "product_name"),
    "issue_id": ("issues", "issue_name"),
    "company_id": ("companies", "company_name"),
}


def _by_name(star: Star, ids: list[str], measures: dict[str, Column], *extra: str) -> DataFrame:
    """Sum ``measures`` (additive aggregates) per name of each id in ``ids``.

    Facts with a NULL or unknown id drop out, as with an inner join.
    """
    per_id = (
        star["complaints"]
        .groupBy(*ids, *extra)
        .agg(*[m.alias(n) for n, m in measures.items()])
    )
    return _name_sums(star, per_id, ids, list(measures), *extra)


def _name_sums(
    star: Star, per_id: DataFrame, ids: list[str], measures: list[str], *extra: str
) -> DataFrame:
    names = []
    for key in ids:
        table, name = _DIMS[key]
        per_id = per_id.join(star[table].select(key, name), key)
        names.append(name)
    return per_id.groupBy(*names, *extra).agg(*[F.sum(n).alias(n) for n in measures])


def _complaints() -> Column:
    return F.count("complaint_id")


def top_companies(star: Star, k: int = 10) -> DataFrame:
    """Companies with the most complaints."""
    counts = _by_name(star, ["company_id"], {"total_complaints": _complaints()})
    return top_k(counts, "total_complaints", k, "company_name")


def high_volume_products(star: Star, n: int = 500) -> DataFrame:
    """Products with more than ``n`` complaints."""
    counts = _by_name(star, ["product_id"], {"complaint_count": _complaints()})
    return order_desc(counts.where(F.col("complaint_count") > n), "complaint_count", "product_name")


def above_average_companies(star: Star) -> DataFrame:
    """Companies above the mean complaints per company id.

    The mean takes in every group of the fact, complaints without a company
    included; the companies compared are those with a name.
    """
    per_id = settle(
        star["complaints"]
        .groupBy("company_id")
        .agg(F.count("*").alias("rows"), _complaints().alias("complaint_count")),
        "company-counts",
    )
    counts = _name_sums(star, per_id, ["company_id"], ["complaint_count"])
    above = above_average(counts, "complaint_count", per_id.agg(F.avg("rows")))
    return order_desc(above, "complaint_count", "company_name")


def volume_tiers(star: Star, tiers=VOLUME_TIERS, k: int = 20) -> DataFrame:
    """The ``k`` largest companies with their volume tier."""
    counts = _by_name(star, ["company_id"], {"total": _complaints()})
    labelled = counts.withColumn("volume_tier", tier(F.col("total"), tiers, LOWEST_TIER))
    return top_k(labelled, "total", k, "company_name")


def top_issues(star: Star, k: int = 3) -> DataFrame:
    """The ``k`` leading issues of each product; ties share a rank and stay."""
    counts = _by_name(star, ["product_id", "issue_id"], {"issue_count": _complaints()})
    ranked = top_per_group(counts, "product_name", "issue_count", k)
    return ranked.orderBy("product_name", "rnk", "issue_name")


def timeliness(star: Star) -> DataFrame:
    """Share of timely responses per submission channel, worst first."""
    rates = rate_by(
        star["complaints"],
        "submitted_via",
        F.col("timely_response"),
        names=("total_complaints", "timely_count", "timely_pct"),
    )
    return rates.orderBy("timely_pct", "submitted_via")


def monthly_ytd(star: Star, drop_null: bool = False) -> DataFrame:
    """Complaints per month and their running total within the year.

    Complaints without a date form a month of their own (NULL); with
    ``drop_null`` they are left out and the month is a 'yyyy-MM' text.
    """
    received = F.col("date_received")
    df = star["complaints"]
    if drop_null:
        df = df.where(received.isNotNull())
        month, year = month_key(received), F.substring("month_start", 1, 4)
    else:
        month, year = month_start(received), F.year("month_start")
    months = count_by(df, month.alias("month_start"), name="monthly_count")
    ytd = running_total(months, "monthly_count", year, "month_start", "ytd_running_total")
    return ytd.orderBy("month_start")


def dispute_states(star: Star, min_n: int = 1000, min_pct: float = 20) -> DataFrame:
    """States (as written) above ``min_n`` complaints and ``min_pct`` disputes."""
    rates = rate_by(
        star["complaints"],
        "state",
        F.col("consumer_disputed"),
        total=_complaints(),
        names=("total_complaints", "disputed", "dispute_rate_pct"),
        min_n=min_n,
        min_pct=min_pct,
    )
    return order_desc(rates, "dispute_rate_pct", "state")


def leading_company(star: Star) -> DataFrame:
    """For each product the company with the most complaints; ties stay."""
    counts = _by_name(star, ["product_id", "company_id"], {"complaints": _complaints()})
    leaders = top_per_group(counts, "product_name", "complaints", 1).drop("rnk")
    return order_desc(leaders, "complaints", "product_name", "company_name")


def resolution_snapshot(star: Star, k: int = 25) -> DataFrame:
    """Volume, timely and disputed counts of the largest product-issue pairs."""
    pairs = _by_name(
        star,
        ["product_id", "issue_id"],
        {
            "total": _complaints(),
            "timely": count_where(F.col("timely_response")),
            "disputed": count_where(F.col("consumer_disputed")),
            "_rows": F.count("*"),
        },
    )
    rated = pairs.withColumn("timely_pct", pct(F.col("timely"), F.col("_rows"), 1)).drop("_rows")
    return top_k(rated, "total", k, "product_name", "issue_name")


def band_by_product(star: Star) -> DataFrame:
    """Complaints per product and response band; needs the enriched fact."""
    counts = _by_name(star, ["product_id"], {"complaint_count": _complaints()}, "response_band")
    return counts.orderBy("product_name", F.desc("complaint_count"), "response_band")


def combined(star: Star, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The fact with the columns of all dimensions; every complaint stays."""
    dims = [(star[table], key) for key, (table, _) in _DIMS.items()]
    return denormalize(star["complaints"], dims, limit)
