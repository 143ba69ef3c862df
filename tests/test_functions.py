"""Scalar functions on the small rows of FIXTURES §3 (X, N, T, M)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fernhill.functions import casts as X
from fernhill.functions.predicates import all_given, non_blank, on_weekday, suffix_and_status
from fernhill.functions.titles import parse_titles


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_short_path_part_is_null(spark):
    assert one(spark, X.path_part("v", 9), "a/b") is None


def test_segment_point(spark):
    seg = "12345678s00042.ts"
    assert one(spark, X.strip_media_suffix("v"), seg) == "1234567800042"
    assert one(spark, X.try_int(X.from_position(X.strip_media_suffix("v"), 9)), seg) == 42
    assert one(spark, X.tail("v", 2), seg) == "ts"


def test_open_dot_quirk(spark):
    # ".ts" is a regex with an open dot: "xts" goes too, and then every "s"
    assert one(spark, X.strip_media_suffix("v"), "axts_s.ts") == "a_"


@pytest.mark.parametrize("text,expected", [("1.5", 2), ("-1.5", -2), ("2.5", 3)])
def test_whole_number_half_up(spark, text, expected):
    assert one(spark, X.whole_number("v"), text) == Decimal(expected)
    assert one(spark, X.try_whole_number("v"), text) == Decimal(expected)


def test_strict_number_raises_lenient_null(spark):
    assert one(spark, X.try_whole_number("v"), "12x") is None
    with pytest.raises(PySparkException):
        one(spark, X.whole_number("v"), "12x")


def test_decimal_10_5(spark):
    assert one(spark, X.try_whole_number("v", 10, 5), "1.123456") == Decimal("1.12346")


def test_lenient_dates(spark):
    assert one(spark, X.try_date("v", "yyyy-MM-dd"), "") is None
    assert one(spark, X.try_timestamp("v"), "junk") is None
    ts = one(spark, X.file_stamp("v"), "s3://b/feed/20220105_101112_items.json.gz")
    assert ts == dt.datetime(2022, 1, 5, 10, 11, 12)
    assert one(spark, on_weekday(X.file_stamp("v"), 4), "x/20220105_101112.gz") is True
    nested = "s3://b/20230101_000000/20240103_101500.json.gz"
    assert one(spark, X.file_stamp("v"), nested) == dt.datetime(2024, 1, 3, 10, 15)
    assert one(spark, X.file_stamp("v"), "s3://b/feed/items.json.gz") is None
    assert one(spark, X.folder_stamp("v"), "20240103_101500") == dt.datetime(2024, 1, 3, 10, 15)


def test_quarter_and_month_periods(spark):
    s, e = X.quarter_period(F.col("v"))
    row = spark.createDataFrame([("in/2022_Q3_TRC.xlsx",), ("in/other.xlsx",), ("in/2022_Q7_TRC.xlsx",)], "v string") \
        .select(s.alias("s"), e.alias("e")).collect()
    assert (row[0].s, row[0].e) == (dt.date(2022, 7, 1), dt.date(2022, 10, 1))
    assert row[1].s is None and row[2].s is None
    s, e = X.month_period(F.col("v"))
    rows = spark.createDataFrame([("05.2022",), ("Summary",)], "v string").select(s.alias("s"), e.alias("e")).collect()
    assert (rows[0].s, rows[0].e) == (dt.date(2022, 5, 1), dt.date(2022, 6, 1))
    assert rows[1].s is None


def test_next_month_clamps(spark):
    d = one(spark, X.next_month(F.col("v").cast("date")), "2022-01-31")
    assert d == dt.date(2022, 2, 28)


def test_comma_and_percent(spark):
    assert one(spark, X.comma_number("v"), "1,234.5") == 1234.5
    assert one(spark, X.percent_ratio("v"), "95%") == pytest.approx(0.95)


def test_tt_and_shorten(spark):
    assert one(spark, X.tt_id("v"), "123") == "tt123"
    assert one(spark, X.tt_id("v"), "No Results") == "No Results"
    assert one(spark, X.tt_id("v"), None) is None
    assert one(spark, X.shorten_title("v"), "A: B - C") == "A: B"
    assert one(spark, X.shorten_title("v"), "plain") is None


def test_as_string_array(spark):
    assert one(spark, X.as_string_array("v"), '["a","b"]') == ["a", "b"]
    assert one(spark, X.as_string_array("v"), "solo") == ["solo"]
    assert one(spark, X.as_string_array("v"), None) is None


def test_predicates(spark):
    df = spark.createDataFrame([("/a/x.ts", "200"), ("/a/x.ts", "404"), ("/a/x.mp4", "200")], "u string, s string")
    assert df.where(suffix_and_status("u", "ts", "s", "200")).count() == 1
    assert one(spark, non_blank("v"), "   ") is False
    assert one(spark, non_blank("v"), None) is False
    assert df.where(all_given(None, None)).count() == 3


TITLES = [
    ("My Show S01E02 - Pilot", ("My Show", None, 1, 2, "- Pilot")),
    ("Foo itemset 3 item 12", ("Foo", None, 3, 12, None)),
    ("Bar (1999)", ("Bar", 1999, None, None, None)),
    ("Baz itemset 4", ("Baz", None, 4, None, None)),
    ("Quux [2090]", ("Quux [2090]", None, None, None, None)),
    ("X_S1_E2_Name", ("X", None, 1, 2, "Name")),
    ("caféS02E05", ("caféS02E05", None, None, None, None)),
]


def test_parse_titles(spark):
    df = spark.createDataFrame([(t, "kept") for t, _ in TITLES] + [(None, "kept")], "title string, other string")
    got = {r.title: r for r in parse_titles(df, "title", "p").collect()}
    for title, expected in TITLES:
        assert tuple(got[title].p) == expected
    assert got[None].p is None and all(r.other == "kept" for r in got.values())


def test_display_title(spark):
    df = spark.createDataFrame([("T", 1999, 1, 2, "rest"), ("T", None, None, None, None)],
                               "t string, y int, s int, e int, r string")
    out = [r[0] for r in df.select(X.display_title("t", "y", "s", "e", "r")).collect()]
    assert out == ['"T" rest, itemset 1 item 2 (1999)', '"T"']
