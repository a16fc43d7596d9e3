"""Reservation layers: history to published reservations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from stallwise.functions.times import last_day
from stallwise.operators.fiscaal import (
    as_fiscaal_reservations,
    clamped_days,
    expand_fiscaal,
    fiscaal_rules,
)
from stallwise.operators.mulder import (
    as_mulder_reservations,
    expand_mulder,
    merge_rules,
    mulder_windows,
)
from stallwise.operators.subtract import mulder_free, remainders, window_pairs

RESERVATION_COLUMNS = [
    "reserverings_key_md5",
    "parkeer_id",
    "parkeer_id_md5",
    "soort",
    "kenteken",
    "reserverings_datum",
    "begin_datum",
    "eind_datum",
    "begin_tijd",
    "eind_tijd",
    "opmerkingen",
    "reservering_bron",
]


def reservations_fiscaal(
    his: DataFrame, as_of: dt.date, horizon: str = "5 days", on_invalid: str = "error"
) -> DataFrame:
    """Reservations from temporary measures; rightly spelled ones come out under two keys."""
    rules = fiscaal_rules(his, as_of, horizon, on_invalid)
    return as_fiscaal_reservations(expand_fiscaal(rules, as_of, horizon))


def reservations_mulder(
    his: DataFrame, as_of: dt.date, horizon: str = "5 days", on_invalid: str = "error"
) -> DataFrame:
    """Reservations from weekly rules, one row per key."""
    windows = mulder_windows(his, last_day(as_of, horizon), on_invalid)
    return as_mulder_reservations(expand_mulder(merge_rules(windows), as_of, horizon))


def reservations_mulder_clean(mul: DataFrame, fis: DataFrame) -> DataFrame:
    """Mulder reservations minus the fiscaal ones of the same spot and day."""
    return mulder_free(mul, fis).unionByName(remainders(window_pairs(mul, fis)))


def mulder_clean_layer(
    his: DataFrame, fis: DataFrame, as_of: dt.date, horizon: str = "5 days", on_invalid: str = "error"
) -> DataFrame:
    """Mulder reservations minus the fiscaal ones ``fis`` of the same days, from the history.

    Rules are told apart before they become days: those of spots without any measure only expand.
    What is looked up day by day are the rules of measured spots alone.
    """
    rules = merge_rules(mulder_windows(his, last_day(as_of, horizon), on_invalid))
    measured = fis.select(F.col("parkeer_id").alias("spot")).distinct()
    free = as_mulder_reservations(expand_mulder(rules.join(measured, "spot", "left_anti"), as_of, horizon))
    hit = as_mulder_reservations(expand_mulder(rules.join(measured, "spot", "left_semi"), as_of, horizon))
    return free.unionByName(reservations_mulder_clean(hit, fis))


def union_reservations(fis: DataFrame, clean: DataFrame) -> DataFrame:
    """Both kinds as one table; keys are kept as they are."""
    return fis.select(*RESERVATION_COLUMNS).unionByName(clean.select(*RESERVATION_COLUMNS))


def published_reservations(his: DataFrame, as_of: dt.date, horizon: str = "5 days") -> DataFrame:
    """The whole chain from the history as one lazy plan."""
    fis = reservations_fiscaal(his, as_of, horizon)
    return union_reservations(fis, mulder_clean_layer(his, fis, as_of, horizon))


def clamped_fiscaal_days(his: DataFrame, as_of: dt.date, horizon: str = "5 days") -> DataFrame:
    """Measures read as one continuous stretch, one row per spot, day and window."""
    rules = fiscaal_rules(his, as_of, horizon)
    days = clamped_days(expand_fiscaal(rules.withColumn("both_valid", F.lit(False)), as_of, horizon))
    return days.select("parkeer_id", "reserverings_datum", "begin_tijd", "eind_tijd").distinct()


def latest_approved_mulder(his: DataFrame, as_of: dt.date, horizon: str = "5 days") -> DataFrame:
    """Weekly rules of the newest approved snapshot only."""
    newest = his.agg(F.max("goedkeurings_datum")).scalar()
    return reservations_mulder(his.filter(F.col("goedkeurings_datum") == newest), as_of, horizon)
