"""Natural text keys.

A key glues its parts together and skips NULLs. The layouts are fixed values that readers of
the published tables rely on: ``{name}`` stands for a column, dates print as ISO dates and
columns ending in ``tijd`` as ``HH:MM:SS``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from stallwise.functions.times import time_text, valid_time

# The key layouts.
HISTORY_KEY = "{parkeer_id}-{tvm_begind}-{tvm_begint}"
FISCAAL_TVM_KEY = "{parkeer_id}-{reserverings_datum}-{begin_tijd}-{eind_tijd}fiscaal-tvm"
TVM_FISCAAL_KEY = "ID{parkeer_id}D{reserverings_datum}BT{begin_tijd}ET{eind_tijd}FISCAAL"
MULDER_KEY = (
    "{parkeer_id}-{reserverings_datum}BT:{begin_tijd}EIND:{eind_tijd}"
    "OPMRK:{opmerkingen}GK:{goedkeurings_datum}soort:MULDER"
)
TRIM_LEFT_KEY = "id{parkeer_id}d{reserverings_datum}bt{begin_tijd}et{eind_tijd}mulder"
TRIM_RIGHT_KEY = "{parkeer_id}-{reserverings_datum}-{begin_tijd}-{eind_tijd}-fiscaal"
SPLIT_KEY = "{parkeer_id}-{reserverings_datum}-{begin_tijd}*{eind_tijd}-m>f"


def natural_key(layout: str, **columns: Column) -> Column:
    """Fill a layout; a placeholder not given as a keyword is the column of that name."""
    parts = []
    for literal, name in re.findall(r"([^{}]+)|\{(\w+)\}", layout):
        if literal:
            parts.append(F.lit(literal))
            continue
        value = columns.get(name, F.col(name))
        parts.append(time_text(value) if name.endswith("tijd") else value.cast("string"))
    return F.concat_ws("", *parts)


def key_around_day(layout: str, **columns: Column) -> tuple[Column, Column]:
    """The parts of a key before and after its day.

    They are the same for every day of a rule, so they are made once before the expansion.
    """
    head, tail = layout.split("{reserverings_datum}")
    return natural_key(head, **columns), natural_key(tail, **columns)


def md5_key() -> Column:
    """md5 of the history key, over the begin time as it stands in the history."""
    return F.md5(natural_key(HISTORY_KEY))


def revalidated(columns: list[str]) -> dict[str, Column]:
    """The text time columns with misspelled values set to NULL."""
    return {c: valid_time(F.col(c)) for c in columns}
