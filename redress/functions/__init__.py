"""Column expressions; all of them stay in the JVM."""

from redress.functions.dates import (
    band,
    days_between,
    month_key,
    month_start,
    parse_date,
    response_band,
    year_of,
)
from redress.functions.rates import count_where, pct, tier
from redress.functions.text import (
    blank_to_null,
    case_key,
    clean_name,
    digits,
    is_blank,
    punct_key,
    safe_int,
    suffix_key,
    tag_array,
    true_flag,
    upper_letters,
    valid_or_null,
    yes_flag,
)

__all__ = [
    "band",
    "blank_to_null",
    "case_key",
    "clean_name",
    "count_where",
    "days_between",
    "digits",
    "is_blank",
    "month_key",
    "month_start",
    "parse_date",
    "pct",
    "punct_key",
    "response_band",
    "safe_int",
    "suffix_key",
    "tag_array",
    "tier",
    "true_flag",
    "upper_letters",
    "valid_or_null",
    "year_of",
    "yes_flag",
]
