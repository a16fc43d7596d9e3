"""Listings over the spot view."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The columns a listing may be filtered on and the page size.
FILTER_COLUMNS = ["id", "buurtcode", "stadsdeel", "straatnaam", "soort", "aantal", "type", "e_type", "bord"]
PAGE_SIZE = 100


def filter_spots(spots: DataFrame, filters: dict) -> DataFrame:
    """Equality filters; a blank or missing value does not filter, nor do unknown names."""
    for name in FILTER_COLUMNS:
        value = filters.get(name)
        if value is not None and value != "":
            spots = spots.filter(F.col(name) == F.lit(value))
    return spots


def list_spots(
    spots: DataFrame, filters: dict | None = None, after_id: str | None = None, n: int = PAGE_SIZE
) -> DataFrame:
    """One page of spots in order of id; the next page starts after the last id of this one.

    Going on from an id costs the same on every page, an offset costs all pages before.
    """
    chosen = filter_spots(spots, filters or {})
    if after_id is not None:
        chosen = chosen.filter(F.col("id") > after_id)
    return chosen.orderBy("id").limit(n)


def page_count(spots: DataFrame, filters: dict | None = None) -> DataFrame:
    """The number of spots a listing has over all its pages."""
    return filter_spots(spots, filters or {}).agg(F.count(F.lit(1)).alias("count"))


def get_spot(spots: DataFrame, spot_id: str) -> DataFrame:
    return spots.filter(F.col("id") == spot_id)


def select_ids(spots: DataFrame, ids: str | DataFrame) -> DataFrame:
    """Spots of a comma-separated id list (not trimmed) or of a DataFrame with an ``id`` column."""
    if isinstance(ids, DataFrame):
        return spots.join(ids.select("id").distinct(), "id", "left_semi")
    return spots.filter(F.col("id").isin(ids.split(",")))


def spot_listing(spots: DataFrame) -> DataFrame:
    """The columns of a full listing, with a display text."""
    display = F.concat(
        F.lit("Parkeervak "), F.coalesce("id", F.lit("None")), F.lit(" te "), F.coalesce("straatnaam", F.lit("None"))
    )
    return spots.select(
        display.alias("_display"),
        "id",
        "buurtcode",
        "straatnaam",
        "aantal",
        "type",
        "e_type",
        "e_type_desc",
        "bord",
        "geometrie",
    )


def simple_listing(spots: DataFrame) -> DataFrame:
    return spots.select("id", "geometrie")
