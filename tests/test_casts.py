import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import casts


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [("2024-02-30", None), ("2024-13-45", None), ("2024-01-05", dt.date(2024, 1, 5)), ("2024-1-5", None),
     (" 2024-01-05", None), ("2024-01-05 10:00:00", None), (None, None)],
)
def test_dates_are_strict(spark, text, expected):
    assert one(spark, casts.to_date_or_null("v"), text) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [("2024-01-05 10:00:59", dt.datetime(2024, 1, 5, 10, 0, 59)), ("2024-01-05", None), ("2024-01-05T10:00:59", None),
     ("2024-01-05 25:00:00", None), ("2024-01-05 10:00:59\n", None)],
)
def test_timestamps_are_strict(spark, text, expected):
    assert one(spark, casts.to_timestamp_or_null("v"), text) == expected


def test_more_timestamp_shapes_on_request(spark):
    both = casts.to_timestamp_or_null("v", ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"))
    assert one(spark, both, "2024-01-05") == dt.datetime(2024, 1, 5)


def test_wall_clock_survives_other_time_zones(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # 02:30 does not exist there on that day
        assert one(spark, casts.to_timestamp_or_null("v"), "2024-03-10 02:30:00") == dt.datetime(2024, 3, 10, 2, 30)
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 01:00:00' a, timestamp_ntz'2024-03-10 04:00:00' b")
        assert df.select(casts.minutes_between("a", "b")).first()[0] == 180
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(("text", "expected"), [("12.5", 13), ("-12.5", -13), ("abc", None), ("", None), ("7", 7)])
def test_integers_round_half_away_from_zero(spark, text, expected):
    got = one(spark, casts.to_integer_or_null("v"), text)
    assert (got if got is None else int(got)) == expected


def test_decimals(spark):
    got = [one(spark, casts.to_decimal_or_null("v", 10, 2), t) for t in ("1.005", "123456789.12", "1e3", " 5 ")]
    assert [None if g is None else float(g) for g in got] == [1.01, None, 1000.0, 5.0]


@pytest.mark.parametrize(("text", "expected"), [("y", True), ("TRUE", True), ("1", True), ("N", False), (None, False)])
def test_flags(spark, text, expected):
    assert one(spark, casts.to_flag("v"), text) is expected


@pytest.mark.parametrize(
    ("a", "b", "minutes", "seconds"),
    [("2024-01-01 00:00:59", "2024-01-01 00:01:01", 1, 2), ("2024-01-01 00:00:00", None, None, None),
     ("2024-01-02 00:00:00", "2024-01-01 23:59:59", -1, -1), ("1969-12-31 23:59:30", "1970-01-01 00:00:10", 1, 40)],
)
def test_boundaries_are_counted(spark, a, b, minutes, seconds):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    df = df.select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    got = df.select(casts.minutes_between("a", "b"), casts.seconds_between("a", "b")).first()
    assert tuple(got) == (minutes, seconds)


def test_percent_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "f bigint, n bigint")
    assert [r[0] for r in df.select(casts.percent(F.col("f"), F.col("n"))).collect()] == [33.333, None]
