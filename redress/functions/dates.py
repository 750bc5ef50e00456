"""Date expressions and the response bands."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Response bands, upper bound in days -> label.
SAME_DAY = "Same Day"
RESPONSE_BANDS = ((3, "1-3 Days"), (7, "4-7 Days"), (14, "8-14 Days"), (30, "15-30 Days"))
OVER_BANDS = "Over 30 Days"
NO_BAND = "Unknown"


def parse_date(c: Column, short: bool = False) -> Column:
    """ISO (yyyy-MM-dd) or MM/dd/yyyy text to a date, NULL for anything else.

    ``short`` also takes months and days of one digit (1/2/2024). The shape is
    tested first: trying one format and then the other would raise and catch an
    error inside for every row in the second one.
    """
    if short:
        parts = F.split(c, "/")
        padded = F.concat_ws(
            "-", F.get(parts, 2), F.lpad(F.get(parts, 0), 2, "0"), F.lpad(F.get(parts, 1), 2, "0")
        )
        brief = c.rlike("^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$")
        return F.when(brief, padded.try_cast("date")).otherwise(parse_date(c))
    us = F.concat_ws("-", F.substring(c, 7, 4), F.substring(c, 1, 2), F.substring(c, 4, 2))
    return F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), c.try_cast("date")).when(
        c.rlike("^[0-9]{2}/[0-9]{2}/[0-9]{4}$"), us.try_cast("date")
    )


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def year_of(d: Column) -> Column:
    return F.year(d)


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def month_key(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def band(c: Column, bounds: Sequence[tuple[int, str]], above: str, missing: str) -> Column:
    """First label whose upper bound holds ``c``; ``above`` past the last one."""
    expr = F.when(c.isNull(), missing)
    for upper, label in bounds:
        expr = expr.when(c <= upper, label)
    return expr.otherwise(above)


def response_band(days: Column) -> Column:
    """Zero days has its own band; negative days fall into the first bounded one."""
    return F.when(days == 0, SAME_DAY).otherwise(
        band(days, RESPONSE_BANDS, OVER_BANDS, NO_BAND)
    )
