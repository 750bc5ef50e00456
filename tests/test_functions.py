import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from redress import functions as fn


def apply(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_suffix_key(spark):
    names = {
        "Abc Co.": "ABC",
        "ABC COMPANY": "ABC",
        "X, N.A.": "X",
        "X National Association": "X",
        "Acme L.L.C.": "ACME",
        "Acme LLC": "ACME",
        "Corp": "",
        "Fooco Inc.": "FOOCO",
        "Éco Bank": "CO BANK",  # an accented letter belongs to its word
        None: None,
    }
    assert apply(spark, names, fn.suffix_key) == list(names.values())


def test_punct_and_case_key(spark):
    names = ["V.I.P. MORTGAGE, INC.", "VIP  Mortgage Inc", "\t Bank\xa0", "a-b  c", None]
    assert apply(spark, names, fn.punct_key) == [
        "VIP MORTGAGE INC", "VIP MORTGAGE INC", "BANK", "AB C", None,
    ]
    assert apply(spark, names, fn.case_key)[2:] == ["BANK", "A-B  C", None]
    assert apply(spark, ["\t Bank "], fn.clean_name) == ["\t BANK"]


def test_dates(spark):
    values = ["2024-01-02", "01/02/2024", "2/30/2024", "02/30/2024", "2024-1-2", "2024", None, ""]
    day = dt.date(2024, 1, 2)
    assert apply(spark, values, fn.parse_date) == [day, day] + [None] * 6
    assert apply(spark, [day, None], fn.month_start, "date") == [dt.date(2024, 1, 1), None]
    assert apply(spark, [day, None], fn.month_key, "date") == ["2024-01", None]
    assert apply(spark, [day, None], fn.year_of, "date") == [2024, None]


def test_response_bands(spark):
    days = [-3, 0, 1, 3, 4, 7, 8, 14, 15, 30, 31, None]
    assert apply(spark, days, fn.response_band, "int") == [
        "1-3 Days", "Same Day", "1-3 Days", "1-3 Days", "4-7 Days", "4-7 Days", "8-14 Days",
        "8-14 Days", "15-30 Days", "15-30 Days", "Over 30 Days", "Unknown",
    ]


def test_text(spark):
    assert apply(spark, ["XXX12", "12345-6", None], fn.digits) == ["12", "123456", None]
    assert apply(spark, [" Ny", "CA ", None], fn.upper_letters) == ["N", "CA", None]
    zips = ["12345", "1234", "123456", None]
    valid = lambda c: fn.valid_or_null(c, "^[0-9]{5}$")
    assert apply(spark, zips, valid) == ["12345", None, None, None]
    ints = ["12", " 12 ", "+5", "-5", "1.0", "abc", "", "99999999999", None]
    assert apply(spark, ints, fn.safe_int) == [12, 12, 5, -5, None, None, None, None, None]
    assert apply(spark, ["", "  ", "x", None], fn.is_blank) == [True, True, False, True]
    assert apply(spark, ["", " ", None], fn.blank_to_null) == [None, " ", None]


def test_flags_differ_on_missing(spark):
    values = ["Yes", "yes", "No", "", None]
    assert apply(spark, values, fn.yes_flag) == [True, False, False, False, False]
    values = ["true", "True", "false", "x", "", None]
    assert apply(spark, values, fn.true_flag) == [True, True, False, False, None, None]


def test_tags(spark):
    values = ["Older American, Servicemember", "One", "", None]
    assert apply(spark, values, fn.tag_array) == [
        ["Older American", "Servicemember"], ["One"], [""], None,
    ]


@pytest.mark.parametrize("places", [1, 2])
def test_pct_is_exact_half_up(spark, places):
    pairs = [(n, d) for d in range(1, 130) for n in range(d + 1)]
    df = spark.createDataFrame([*pairs, (1, 0)], "n long, d long")
    rows = df.select("n", "d", fn.pct(F.col("n"), F.col("d"), places).alias("p")).collect()
    unit = Decimal(1).scaleb(-places)
    for n, d, p in rows:
        if d == 0:
            assert p is None
        else:
            exact = (Decimal(100 * n) / Decimal(d)).quantize(unit, ROUND_HALF_UP)
            assert p == float(exact), (n, d)


def test_tier(spark):
    floors = ((100, "A"), (10, "B"))
    expr = lambda c: fn.tier(c, floors, "C")
    assert apply(spark, [100, 99, 10, 9], expr, "int") == ["A", "B", "B", "C"]
