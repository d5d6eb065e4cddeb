import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from helpers import evaluate
from stayflow import functions as fn
from stayflow.functions import measures
from stayflow.functions.parse import AMOUNT_SENTINELS

CASES = {
    "number": (
        fn.parse_number,
        {"12.7": 13, "-2.5": -3, " 12 ": 12, "01": 1, "abc": None, "": None, "NaN": None, "1,000": None,
         "99999999999999999999": None},
    ),
    "amount": (
        lambda c: fn.parse_decimal(fn.null_if_sentinel(c, AMOUNT_SENTINELS)),
        {" NaN ": None, "??": None, "none": None, "123.456": D("123.46"), "-1.005": D("-1.01"),
         "1,234.50": None, "99999999999.00": None, "99999999.99": D("99999999.99")},
    ),
    "timestamp": (
        fn.parse_ts,
        {"2024-01-15 10:11:12": dt.datetime(2024, 1, 15, 10, 11, 12), "2024-01-15": None,
         "2024-13-45 00:00:00": None},
    ),
    "yes/no": (fn.parse_flag, {" yes ": True, "NO": False, "Y": None, "": None}),
    "true/false": (
        lambda c: fn.parse_flag(c, "TRUE", "FALSE"), {"true": True, " FALSE": False, "1": None}
    ),
    "name": (
        fn.clean_name,
        {"##jOHN  o@neil": "John  Oneil", "o'neil-smith": "O'neil-smith", "###": ""},
    ),
    "words": (lambda c: fn.initcap_words(c, " '-"), {"o'NEIL-smith jr": "O'Neil-Smith Jr", "": ""}),
    "email": (
        fn.clean_email,
        {" John#Doe @Mail.COM ": "johndoe@mail.com", "john.mail.com": None, "a@b": None, "@.": "@."},
    ),
    "phone": (
        fn.normalize_phone,
        {"(555) 123-4567 x99": "+15551234567", "001-555-123-4567": "+15551234567",
         "+1 555 123 4567": "+15551234567", "12345": "12345", "441234567890": "441234567890",
         "ext": None, "n/a": None, "": None},
    ),
    "city": (
        fn.clean_city,
        {"??": None, "@@@": None, "": None, " new york#": "New York", "N/A": "N/a"},
    ),
    "hotel name": (fn.clean_hotel_name, {"grand-HOTEL, #1": "Grand Hotel 1"}),
    "hotel city": (fn.clean_label, {"": "", "rome&": "Rome"}),
    "shift": (fn.clean_shift, {"Night-2": "NIGHT", "day shift!": "DAY SHIFT", "": ""}),
    "comments": (fn.clean_comments, {"###": None, "  ok & GOOD ": "Ok  Good", "": None}),
    "sentiment": (fn.clean_sentiment, {" NEGATIVE ": "Negative", "positive": "Positive"}),
}


@pytest.mark.parametrize("name", CASES)
def test_cleaning_rule(spark, name):
    apply, rows = CASES[name]
    texts = [*rows, None]
    assert dict(zip(texts, evaluate(spark, apply, texts))) == {**rows, None: None}


def test_tier_boundaries(spark):
    values = [D("4999.99"), D("5000.00"), D("19999.99"), D("20000.00"), D("49999.99"), D("50000.00"), None]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(22,2)")
    tiers = [r.t for r in df.select(measures.customer_tier(F.col("v")).alias("t")).collect()]
    assert tiers == ["bronze", "silver", "silver", "gold", "gold", "platinum", "bronze"]


def test_band_boundaries(spark):
    rows = [
        (D("520000.00"), 3.0, "Top Performer"),
        (D("520000.00"), 2.99, "At Risk"),
        (D("519999.99"), 3.0, "Hidden Gem"),
        (D("519999.99"), 2.99, "Needs Attention"),
        (None, 3.0, "Unclassified"),
        (D("520000.00"), None, "Unclassified"),
    ]
    df = spark.createDataFrame(rows, "revenue decimal(22,2), rating double, band string")
    band = measures.performance_band(F.col("revenue"), F.col("rating"))
    assert df.where(~band.eqNullSafe(F.col("band"))).count() == 0


def test_percent_rounds_half_up_and_survives_zero(spark):
    df = spark.createDataFrame([(1, 16), (1, 3), (5, 5), (0, 0), (1, 2000)], "a bigint, b bigint")
    got = [r[0] for r in df.select(measures.percent(F.col("a"), F.col("b"))).collect()]
    assert got == [6.3, 33.3, 100.0, None, 0.1]


def test_null_counts_as_no(spark):
    df = spark.createDataFrame([(True,), (None,), (False,)], "f boolean")
    assert df.agg(measures.count_when(F.col("f"))).first()[0] == 1
    assert df.where("f is null").agg(measures.count_when(F.col("f"))).first()[0] == 0
