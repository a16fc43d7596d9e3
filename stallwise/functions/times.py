"""Free-text times of day and day horizons."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Fixed value: the accepted spelling of a time of day.
TIME_PATTERN = r"^[0-9][0-9]?[:;][0-9][0-9]?([:;][0-9][0-9]?)?\z"

# The spellings that name a time that exists; 24:00 and a second of 60 do.
IN_RANGE_PATTERN = (
    r"^(?:(?:[01]?[0-9]|2[0-3])[:;][0-5]?[0-9](?:[:;](?:[0-5]?[0-9]|60))?|24[:;]0?0(?:[:;]0?0)?)\z"
)

DAY_START = 0
DAY_END = 86399


def is_time(text: Column) -> Column:
    """Whether the text is spelled like a time. NULL text gives NULL."""
    return text.rlike(TIME_PATTERN)


def valid_time(text: Column) -> Column:
    """The text itself when it is spelled like a time, else NULL."""
    return F.when(is_time(text), text)


def parse_time(text: Column, default: int, on_invalid: str = "error") -> Column:
    """Seconds of day of a text time; ``default`` when it is NULL or not spelled like a time.

    The spelling admits impossible values such as ``9:60``. Like a SQL cast to ``time`` these
    raise; ``on_invalid="null"`` gives them the default instead.
    """
    if on_invalid not in ("error", "null"):
        raise ValueError(f"on_invalid must be 'error' or 'null', not {on_invalid!r}")
    # The added part stands for the seconds where there are none.
    colons = F.concat(F.translate(text, ";", ":"), F.lit(":0"))

    def part(n: int) -> Column:
        return F.split_part(colons, F.lit(":"), F.lit(n)).cast("int")

    total = part(1) * 3600 + part(2) * 60 + part(3)
    parsed = F.when(text.rlike(IN_RANGE_PATTERN), total)
    if on_invalid == "error":
        complaint = F.concat(F.lit("time of day out of range: "), text)
        parsed = parsed.when(is_time(text), F.raise_error(complaint).cast("int"))
    return parsed.otherwise(F.lit(default))


def time_text(seconds: Column) -> Column:
    """Seconds of day as ``HH:MM:SS``."""
    hours = F.floor(seconds / 3600)
    minutes = F.floor(F.pmod(seconds, F.lit(3600)) / 60)
    two_digits = [F.lpad(n.cast("string"), 2, "0") for n in (hours, minutes, F.pmod(seconds, F.lit(60)))]
    return F.concat_ws(":", *two_digits)


def first_day(as_of: dt.date) -> Column:
    return F.lit(as_of).cast("date")


def last_day(as_of: dt.date, horizon: str) -> Column:
    """Last day of a horizon such as ``"5 days"`` or ``"1 year"``, itself included."""
    words = horizon.split()
    if len(words) % 2 or not all(w.lstrip("-").isdigit() if i % 2 == 0 else w.isalpha() for i, w in enumerate(words)):
        raise ValueError(f"not a horizon: {horizon!r}")
    return (first_day(as_of) + F.expr(f"interval {horizon}")).cast("date")


def days_between(first: Column, last: Column) -> Column:
    """Every day from ``first`` to ``last``, both included; an empty array when there is none.

    ``sequence`` counts down or raises on a reversed range, hence the guard.
    """
    return F.when(
        first <= last, F.sequence(first, F.greatest(first, last), F.expr("interval 1 day"))
    ).otherwise(F.array().cast("array<date>"))


def day_of_week(day: Column) -> Column:
    """Sunday 0 to Saturday 6."""
    return F.dayofweek(day) - 1
