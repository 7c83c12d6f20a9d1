"""Feed text parsing and calendar parts."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import functions as X


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    ("day", "clock", "expected"),
    [
        ("8 Aug 2023", "07:05", datetime(2023, 8, 8, 7, 5)),
        ("08 Aug 2023", "7:05", datetime(2023, 8, 8, 7, 5)),
        ("8 Aug 2023", None, datetime(2023, 8, 8)),
        ("8 Aug 2023", "nan", datetime(2023, 8, 8)),
        ("12 Mar 2023", "02:30", datetime(2023, 3, 12, 2, 30)),
        ("8 Foo 2023", "07:05", None),
        ("8 Aug 2023", "25:00", None),
        ("8 Aug 2023", "soon", None),
        (None, "07:05", None),
    ],
)
def test_date_and_time(spark, zone, day, clock, expected):
    df = spark.createDataFrame([(day, clock)], "d string, t string")
    assert df.select(X.date_and_time(F.col("d"), F.col("t"))).first()[0] == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2023-08-08 07:05", datetime(2023, 8, 8, 7, 5)),
        ("2023-03-12 02:30", datetime(2023, 3, 12, 2, 30)),
        ("2023-08", None),
        ("2023-13-08 07:05", None),
        ("2023-08-08T07:05Z", None),
        (None, None),
    ],
)
def test_minute_timestamp(spark, zone, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(X.minute_timestamp(F.col("t"))).first()[0] == expected


@pytest.mark.parametrize(("text", "expected"), [("X", 0), ("12", 12), ("some", None), (None, None)])
def test_count_or_zero(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(X.count_or_zero(F.col("t"))).first()[0] == expected


def test_wall_clock_is_utc_in_any_zone(spark, zone):
    df = spark.range(1).select(X.wall_clock(F.expr("timestamp'2023-03-12T07:30:00.123456Z'")).alias("w"))
    assert df.schema["w"].dataType.simpleString() == "timestamp_ntz"
    assert df.first()[0] == datetime(2023, 3, 12, 7, 30, 0, 123456)


def test_day_parts(spark, zone):
    df = spark.createDataFrame([(datetime(2023, 8, 8, 7, 5),)], "t timestamp_ntz")
    row = df.select(*[c.alias(n) for n, c in X.day_parts(F.col("t")).items()]).first()
    assert tuple(row) == (8, 8, "August", 2023, 3)


def test_month_label(spark):
    df = spark.createDataFrame([(datetime(2023, 8, 8, 7, 5),), (None,)], "t timestamp_ntz")
    assert [r[0] for r in df.select(X.month_label(F.col("t"))).collect()] == ["2023-08", "unknown"]
