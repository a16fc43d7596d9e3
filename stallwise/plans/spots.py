"""Spot layers: history to published spots and the views over them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from stallwise.functions.geometry import centroid, geo_id, tag_srid
from stallwise.operators.dedupe import first_per_key
from stallwise.operators.overlay import make_valid
from stallwise.sources.scratch import materialized

SPOT_ATTRIBUTES = ["stadsdeel", "buurtcode", "straatnaam", "soort", "type", "aantal", "e_type", "bord"]

# Fixed value: the sign of a bay for one licence plate, whose text would give the plate away.
PLATE_SIGN = "E6b"


def build_spots(his: DataFrame) -> DataFrame:
    """One row per spot out of the history rows whose repaired shape is a multipolygon.

    Rules and snapshots of a spot mostly share one shape. Rows of equal shape are merged to
    the one that would win anyway before shapes are examined, which is the costly part.
    """
    rows = his.select("parkeer_id", *SPOT_ATTRIBUTES, "geom")
    best = rows.groupBy("parkeer_id", F.xxhash64("geom").alias("hash"), "geom").agg(
        F.min(F.struct(*SPOT_ATTRIBUTES)).alias("best")
    )
    merged = best.select(F.col("parkeer_id").alias("parkeer_id_md5"), "parkeer_id", "best.*", "geom")
    sound = make_valid(materialized(merged), "geom").filter(F.col("geometry_kind") == "MultiPolygon")
    return first_per_key(sound.drop("geometry_kind"), ["parkeer_id"])


def publish_spots(spots: DataFrame) -> DataFrame:
    """Spots with their centre and the id made of it; both geometries name their reference system."""
    centred = spots.withColumn("geo_id", centroid(F.col("geom")))
    return centred.select(
        "parkeer_id_md5",
        "parkeer_id",
        geo_id(F.col("geo_id")).alias("parkeer_geo_id"),
        *SPOT_ATTRIBUTES,
        tag_srid(F.col("geom"), "geom"),
        tag_srid(F.col("geo_id"), "geo_id"),
    )


def masked_sign() -> Column:
    """The sign text, except on a bay for one plate."""
    return F.when(F.col("e_type") == PLATE_SIGN, None).otherwise(F.col("bord"))


def with_sign_title(spots: DataFrame, e_types: DataFrame) -> DataFrame:
    """Add ``e_type_desc``. Spark broadcasts the code list when it is small."""
    titles = e_types.select(F.col("code").alias("e_type"), F.col("title").alias("e_type_desc"))
    return spots.join(titles, "e_type", "left")


def geo_spots(spots: DataFrame, e_types: DataFrame) -> DataFrame:
    """The spot view."""
    return with_sign_title(spots, e_types).select(
        F.col("parkeer_id").alias("id"),
        F.col("parkeer_geo_id").alias("geo_id"),
        "buurtcode",
        "stadsdeel",
        "straatnaam",
        "aantal",
        "soort",
        "type",
        "e_type",
        "e_type_desc",
        masked_sign().alias("bord"),
        F.col("geom").alias("geometrie"),
    )


def spots_on_day(spots: DataFrame, reservations: DataFrame, day: dt.date) -> DataFrame:
    """Every spot with each of its reservations of a day, or with none.

    A left join could not split a spot with very many reservations over tasks. The spots with
    reservations therefore come from an inner join, which adaptive execution can split on
    either side, and the others from an anti join with the distinct spots reserved. The day is
    read for each of the two joins, so ``reservations`` should be a stored table.
    """
    todays = reservations.filter(F.col("reserverings_datum") == F.lit(day).cast("date")).select(
        "parkeer_id_md5", "begin_datum", "eind_datum", F.col("soort").alias("re_soort"), "opmerkingen",
        F.col("reserverings_datum").alias("day"),
    )
    reserved = spots.join(todays, "parkeer_id_md5")
    free = spots.join(todays.select("parkeer_id_md5").distinct(), "parkeer_id_md5", "left_anti")
    return reserved.unionByName(free, allowMissingColumns=True)


def geo_spots_today(
    spots: DataFrame, reservations: DataFrame, e_types: DataFrame, as_of: dt.date
) -> DataFrame:
    """The view of spots with the reservations of ``as_of``."""
    return with_sign_title(spots_on_day(spots, reservations, as_of), e_types).select(
        F.col("parkeer_id").alias("id"),
        "buurtcode",
        "stadsdeel",
        "straatnaam",
        "aantal",
        F.col("geom").alias("geometrie"),
        "e_type",
        "e_type_desc",
        masked_sign().alias("bord"),
        "begin_datum",
        "eind_datum",
        F.col("re_soort").alias("soort"),
        "opmerkingen",
        "day",
    )
