import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stallwise.functions.keys import HISTORY_KEY, md5_key, natural_key
from stallwise.functions.times import days_between, last_day, parse_time, time_text, valid_time
from stallwise.operators.calendar import calendar, history_calendar

TIMES = [
    ("9:00", 32400, "09:00:00"),
    ("09;30", 34200, "09:30:00"),
    ("7:5", 25500, "07:05:00"),
    ("13:00:07", 46807, "13:00:07"),
    ("24:00", 86400, "24:00:00"),
    ("23;59;60", 86400, "24:00:00"),
    ("onbekend", 5, None),
    ("9:00 ", 5, None),
    ("9:00\n", 5, None),
    ("9", 5, None),
    ("", 5, None),
    (None, 5, None),
]


def test_parse_time(spark):
    d = spark.createDataFrame([(t,) for t, _, _ in TIMES], "t string")
    rows = d.select(parse_time(F.col("t"), 5).alias("s"), valid_time(F.col("t")).alias("v")).collect()
    assert [r.s for r in rows] == [s for _, s, _ in TIMES]
    assert [r.v for r in rows] == [t if text else None for t, _, text in TIMES]


def test_time_text(spark):
    d = spark.createDataFrame([(s,) for _, s, text in TIMES if text], "s int")
    assert [r[0] for r in d.select(time_text(F.col("s"))).collect()] == [t for _, _, t in TIMES if t]


@pytest.mark.parametrize("text", ["9:60", "99:99", "24:01", "12:00:61"])
def test_impossible_time(spark, text):
    d = spark.createDataFrame([(text,)], "t string")
    with pytest.raises(PySparkException):
        d.select(parse_time(F.col("t"), 7)).collect()
    assert d.select(parse_time(F.col("t"), 7, "null")).first()[0] == 7


def test_key_skips_nulls(spark):
    d = spark.createDataFrame([("A", None, "9:00")], "parkeer_id string, tvm_begind date, tvm_begint string")
    row = d.select(natural_key(HISTORY_KEY).alias("k"), md5_key().alias("m"), F.md5(F.lit("A--9:00")).alias("want")).first()
    assert row.k == "A--9:00" and row.m == row.want


def test_reversed_days_are_empty(spark):
    d = spark.createDataFrame([(dt.date(2020, 1, 3), dt.date(2020, 1, 1))], "a date, b date")
    assert d.select(days_between(F.col("a"), F.col("b"))).first()[0] == []


def test_calendar(spark):
    days = calendar(spark, dt.date(2020, 2, 27), "5 days").collect()
    assert [r.datum.day for r in days] == [27, 28, 29, 1, 2, 3]
    assert [r.dag for r in days] == [4, 5, 6, 0, 1, 2]
    assert calendar(spark, dt.date(2020, 1, 1), "1 year").count() == 367
    his = spark.createDataFrame([(dt.date(2020, 1, 1),), (dt.date(2020, 1, 2),), (dt.date(2020, 1, 2),)], "goedkeurings_datum date")
    assert history_calendar(his, dt.date(2020, 1, 1), "5 days").count() == 12
    assert history_calendar(his.limit(0), dt.date(2020, 1, 1)).count() == 0


def test_horizon_text():
    with pytest.raises(ValueError):
        last_day(dt.date(2020, 1, 1), "5 days; drop")
