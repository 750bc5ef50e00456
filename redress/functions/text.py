"""String, flag and key expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal-form words dropped from a company name by suffix_key.
LEGAL_SUFFIXES = (
    r"\b(LLC|L\.?L\.?C\.?|INC\.?|INCORPORATED|CORP\.?|CORPORATION|CO\.?|COMPANY"
    r"|LTD\.?|LIMITED|N\.?A\.?|NATIONAL ASSOCIATION)\b"
)

# Every character that counts as white space in Unicode text; Spark's trim
# alone removes only the plain space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def clean_name(c: Column) -> Column:
    """Upper case without surrounding spaces: the stored company name."""
    return F.upper(F.trim(c))


def case_key(c: Column) -> Column:
    """Key under which names differing in case or outer white space meet."""
    return F.upper(F.btrim(c, F.lit(WHITESPACE)))


def _squeeze(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), " +", " ")


def punct_key(c: Column) -> Column:
    """Key that also ignores everything but letters, digits and spaces."""
    return _squeeze(F.regexp_replace(F.upper(c), "[^A-Za-z0-9 ]", ""))


def suffix_key(c: Column) -> Column:
    """Key that also ignores legal forms; may be empty ('Corp')."""
    # (?U): an accented letter is part of a word, so no suffix starts after it.
    bare = F.regexp_replace(F.upper(c), "(?U)" + LEGAL_SUFFIXES, "")
    return _squeeze(F.regexp_replace(bare, "[^A-Z0-9 ]", ""))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def upper_letters(c: Column) -> Column:
    """Keeps A-Z only; lower-case letters are removed, not raised."""
    return F.trim(F.regexp_replace(c, "[^A-Z]", ""))


def valid_or_null(c: Column, pattern: str) -> Column:
    return F.when(c.rlike(pattern), c)


def safe_int(c: Column, to: str = "int") -> Column:
    """Whole number in text, NULL for what is not one (a plain cast would raise).

    The pattern keeps text that is no number away from the cast, where each
    failure costs an exception; the cast still turns an overflow into NULL.
    """
    return F.when(c.rlike(r"^[\x00- ]*[+-]?[0-9]+[\x00- ]*$"), c.try_cast(to))


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def yes_flag(c: Column) -> Column:
    """'Yes' is true, anything else and NULL false (rule of the split)."""
    return F.coalesce(c == "Yes", F.lit(False))


def true_flag(c: Column) -> Column:
    """'true' in any case is true, other text false, empty NULL (rule of the load)."""
    return F.lower(blank_to_null(c)) == "true"


def tag_array(c: Column) -> Column:
    return F.split(c, r",\s*")
