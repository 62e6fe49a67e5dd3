"""Scalar functions on small literal fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from starloom.functions import dates as fd
from starloom.functions import numbers as fn
from starloom.functions import text as ft


def _one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_names_cleaning(spark):
    df = _one_col(spark, ["\t (a), b;  ", "", "  ", None, "x?y", "　z "])
    out = [r[0] for r in df.select(ft.clean_text("x")).collect()]
    assert out == ["a   b", "Not Provided", "Not Provided", "Not Provided", "x y", "z"]


def test_punct_runs_not_collapsed(spark):
    df = _one_col(spark, ["a,,b", "(c)"])
    assert [r[0] for r in df.select(ft.punct_to_space("x")).collect()] == ["a  b", " c "]


def test_strip_matches_python(spark):
    samples = ["\x1c a \x1f", " b ", "\x85c\x0b", " inner  space "]
    df = _one_col(spark, samples)
    got = [r[0] for r in df.select(ft.strip_unicode("x")).collect()]
    assert got == [s.strip() for s in samples]


def test_prices_round_half_even(spark):
    df = _one_col(spark, [0.5, 1.5, 2.5, -0.5, 3.49], "double")
    got = [r[0] for r in df.select(fn.round_half_even_long(F.col("x"))).collect()]
    assert got == [0, 2, 2, 0, 3]


def test_numbers_per_cell(spark):
    vals = [" 12 ", "1e3", "0x10", "1,000", "abc", "inf", "1d", "7"]
    df = _one_col(spark, vals)
    got = [r[0] for r in df.select(fn.parse_double("x")).collect()]
    assert got == [12.0, 1000.0, None, None, None, None, None, 7.0]


def test_long_keys_keep_digits(spark):
    df = _one_col(spark, ["9007199254740993", "12.0", "1.5", " 4 "])
    got = [r[0] for r in df.select(fn.parse_long("x")).collect()]
    assert got == [9007199254740993, 12, None, 4]


def test_quantities_whole_only(spark):
    df = _one_col(spark, [1.0, 1.5, 0.0, -2.0, None], "double")
    got = [r[0] for r in df.select(fn.whole_to_long(F.col("x"))).collect()]
    assert got == [1, None, 0, -2, None]


def test_dates(spark):
    vals = ["2007-01-02", "2007-01-02T00:00:00", "2007-01-04 10:00:00", "01/03/2007",
            "Not Provided", None]
    df = _one_col(spark, vals)
    got = [r[0] for r in df.select(fd.parse_order_date("x")).collect()]
    assert got == [dt.datetime(2007, 1, 2), dt.datetime(2007, 1, 2),
                   dt.datetime(2007, 1, 4, 10), None, None, None]


def test_calendar_attributes(spark):
    df = spark.createDataFrame([(dt.date(2007, 1, 1),), (dt.date(2010, 1, 3),),
                                (dt.date(2012, 12, 31),)], "d date")
    rows = df.select(fd.date_key("d"), fd.full_date_description("d"), F.weekofyear("d"),
                     fd.is_weekday("d"), F.quarter("d")).collect()
    assert tuple(rows[0]) == (20070101, "Monday, 01 January 2007", 1, 1, 1)
    assert rows[1][2] == 53 and rows[1][3] == 0
    assert rows[2][2] == 1 and rows[2][4] == 4


def test_dates_do_not_depend_on_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = _one_col(spark, ["2007-03-11 02:30:00", "2007-03-11"])
        got = [r[0] for r in df.select(fd.parse_order_date("x")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [dt.datetime(2007, 3, 11, 2, 30), dt.datetime(2007, 3, 11)]
