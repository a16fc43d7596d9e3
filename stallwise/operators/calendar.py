"""Calendar days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from stallwise.functions.times import day_of_week, days_between, first_day, last_day


def calendar(spark: SparkSession, as_of: dt.date, horizon: str = "5 days") -> DataFrame:
    """Each day from ``as_of`` to the end of the horizon once, with its day of week."""
    days = spark.range(1).select(
        F.explode(days_between(first_day(as_of), last_day(as_of, horizon))).alias("datum")
    )
    return days.withColumn("dag", day_of_week(F.col("datum")))


def snapshot_dates(his: DataFrame) -> DataFrame:
    """The approval dates present in the history."""
    return his.select("goedkeurings_datum").distinct()


def history_calendar(his: DataFrame, as_of: dt.date, horizon: str = "5 days") -> DataFrame:
    """The calendar table: every day once per approval date, empty for an empty history."""
    days = snapshot_dates(his).select(
        F.explode(days_between(first_day(as_of), last_day(as_of, horizon))).alias("datum")
    )
    return days.withColumn("dag", day_of_week(F.col("datum")))
