"""Registered spot, view and geometry queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stallwise.functions.geometry import area, centroid, geo_id
from stallwise.functions.rd import request_point
from stallwise.operators.checks import check_layers, orphan_reservations, standard_expectations
from stallwise.operators.listing import (
    filter_spots,
    get_spot,
    list_spots,
    page_count,
    select_ids,
    simple_listing,
    spot_listing,
)
from stallwise.operators.overlay import dissolve_parts, dissolve_selection, group_counts, make_valid
from stallwise.operators.spatial import geosearch, spots_at_points
from stallwise.plans.reservations import published_reservations, reservations_fiscaal
from stallwise.plans.spots import (
    build_spots,
    geo_spots,
    geo_spots_today,
    publish_spots,
    spots_on_day,
    with_sign_title,
)
from stallwise.sources.publish import publish, read_published
from stallwise.sources.scratch import materialized, scratch_dir
from stallwise.sources.sign_types import e_types
from workload import oracle as o
from workload.fixtures import (
    AS_OF,
    HORIZON,
    POINTS_SQL,
    RECTANGLES_SQL,
    REQUESTS_SQL,
    TODAY,
    WGS84_SQL,
    derive,
    duck,
    history,
    history_with_shapes,
    model_spots,
    points,
    read,
    rectangles,
)
from workload.reservations import plain


SELECTED_IDS = "P3,P14, P15,P92,,P0"


def published(spark: SparkSession, sf: str) -> DataFrame:
    return publish_spots(model_spots(spark, sf))


def view(spark: SparkSession, sf: str) -> DataFrame:
    return geo_spots(published(spark, sf), e_types(spark))


def todays(spark: SparkSession, sf: str) -> DataFrame:
    """Reservations of the day itself, written once: days do not depend on each other, so no other is made."""
    return materialized(published_reservations(history(spark, sf), TODAY, "0 days"))


def stored(spark: SparkSession, sf: str) -> DataFrame:
    """The reservations of all days as a published table, a folder for each day."""
    path = f"{scratch_dir(spark)}/reservations"
    publish(published_reservations(history(spark, sf), AS_OF, HORIZON), path, ["reserverings_datum"])
    return read_published(spark, path)


def measured(d: DataFrame, geom: str) -> DataFrame:
    """The area in place of the geometry."""
    return d.withColumn("oppervlak", F.round(area(F.col(geom)), 6)).drop(geom)


def make_valid_query(spark: SparkSession, sf: str) -> DataFrame:
    his = history_with_shapes(spark, sf).select("parkeer_id", "shape", "geom")
    valid = make_valid(his, "geom")
    kept = F.when(F.col("geometry_kind") == "MultiPolygon", F.col("geom"))
    return valid.select(
        "parkeer_id", "shape", "geometry_kind", F.coalesce(F.round(area(kept), 6), F.lit(0.0)).alias("oppervlak")
    )


def build_spots_query(spark: SparkSession, sf: str) -> DataFrame:
    return measured(build_spots(history_with_shapes(spark, sf)), "geom")


def centroid_query(spark: SparkSession, sf: str) -> DataFrame:
    centred = model_spots(spark, sf).withColumn("c", centroid(F.col("geom")))
    return centred.select("parkeer_id", F.round("c.x", 6).alias("cx"), F.round("c.y", 6).alias("cy"), geo_id(F.col("c")).alias("geo_id"))


def publish_spots_query(spark: SparkSession, sf: str) -> DataFrame:
    return measured(published(spark, sf).drop("geo_id"), "geom")


def sign_title_query(spark: SparkSession, sf: str) -> DataFrame:
    return with_sign_title(model_spots(spark, sf), e_types(spark)).select("parkeer_id", "e_type", "e_type_desc")


def spots_on_day_query(spark: SparkSession, sf: str) -> DataFrame:
    d = spots_on_day(published(spark, sf), stored(spark, sf), TODAY)
    return plain(d.select("parkeer_id", "re_soort", "opmerkingen", "begin_datum", "eind_datum", "day"))


def geo_spots_today_query(spark: SparkSession, sf: str) -> DataFrame:
    return plain(measured(geo_spots_today(published(spark, sf), todays(spark, sf), e_types(spark), TODAY), "geometrie"))


def spots_at_points_query(spark: SparkSession, sf: str) -> DataFrame:
    return spots_at_points(points(spark, sf), view(spark, sf))


def wgs84_query(spark: SparkSession, sf: str) -> DataFrame:
    none = F.lit(None).cast("double")
    x, y = request_point(F.col("lat"), F.col("lon"), none, none)
    return derive(spark, sf, WGS84_SQL).select("pid", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


def dissolved(d: DataFrame, by: str, geom: str) -> DataFrame:
    """Count and area of the union per group, without gathering a group's shape in one row."""
    areas = (
        dissolve_parts(d, [by], geom)
        .groupBy(by)
        .agg(F.round(F.sum(area(F.array("polygon"))), 3).alias("oppervlak"))
    )
    return group_counts(d, [by]).join(areas, by, "left")


def list_query(spark: SparkSession, sf: str) -> DataFrame:
    page = list_spots(view(spark, sf), {"e_type": "E8", "buurtcode": "", "stadsdeel": None}, after_id="P1")
    return page.select("id", "straatnaam", "e_type", "e_type_desc", "bord")


def filter_query(spark: SparkSession, sf: str) -> DataFrame:
    chosen = filter_spots(view(spark, sf), {"soort": "MULDER", "aantal": 2, "straatnaam": "", "type": "haaks"})
    return chosen.select("id", "soort", "aantal", "type")


def select_ids_query(spark: SparkSession, sf: str) -> DataFrame:
    ids = read(spark, sf, "customer").select(F.concat(F.lit("P"), F.col("c_custkey")).alias("id"))
    return select_ids(view(spark, sf), ids).select("id", "geo_id")


def geoselection_query(spark: SparkSession, sf: str) -> DataFrame:
    """A selection by street and one by ids; untrimmed, blank and unknown ids choose nothing."""
    spots = view(spark, sf)

    def chosen(by: str, **selection: str) -> DataFrame:
        d = dissolve_selection(spots, **selection)
        shape = F.col("singleshape")
        return d.select(F.lit(by).alias("keuze"), "aantal", F.size(shape).alias("delen"), F.round(area(shape), 3).alias("oppervlak"))

    return chosen("straat", street="straat 3").unionByName(chosen("ids", ids=SELECTED_IDS))


def spot_listing_query(spark: SparkSession, sf: str) -> DataFrame:
    return measured(spot_listing(view(spark, sf)), "geometrie")


def orphans_query(spark: SparkSession, sf: str) -> DataFrame:
    signed = published(spark, sf).filter(F.col("e_type").isNotNull())
    return orphan_reservations(published_reservations(history(spark, sf), AS_OF, HORIZON), signed)


def check_layers_query(spark: SparkSession, sf: str) -> DataFrame:
    spots, his = published(spark, sf), history(spark, sf)
    res = reservations_fiscaal(his, AS_OF, HORIZON)
    files = his.select("stadsdeel").distinct()
    return check_layers(
        {"history": his, "spots": spots, "reservations": res}, standard_expectations(spots, res, files)
    )


QUERIES = {
    "j2_make_valid": make_valid_query,
    "m1_build_spots": build_spots_query,
    "j5_centroid": centroid_query,
    "m5_publish_spots": publish_spots_query,
    "c5_with_sign_title": sign_title_query,
    "m7_geo_spots": lambda s, d: measured(view(s, d), "geometrie"),
    "c6_spots_today": spots_on_day_query,
    "m8_geo_spots_today": geo_spots_today_query,
    "c7_spots_at_points": spots_at_points_query,
    "j8_wgs84_to_rd": wgs84_query,
    "d1_dissolve_by_street": lambda s, d: dissolved(view(s, d), "straatnaam", "geometrie"),
    "j9_dissolve": lambda s, d: dissolved(rectangles(s, d), "straatnaam", "geom"),
    "f1_list_spots": list_query,
    "b10_filter_spots": filter_query,
    "b11_select_ids": select_ids_query,
    "b15_spot_listing": spot_listing_query,
    "b15_simple_listing": lambda s, d: measured(simple_listing(view(s, d)), "geometrie"),
    "b11_select_ids_text": lambda s, d: select_ids(view(s, d), SELECTED_IDS).select("id", "geo_id"),
    "f2_get_spot": lambda s, d: measured(get_spot(view(s, d), "P7"), "geometrie"),
    "geosearch": lambda s, d: geosearch(derive(s, d, REQUESTS_SQL), view(s, d)),
    "geoselection": geoselection_query,
    "d8_page_count": lambda s, d: page_count(view(s, d), {"soort": "FISCAAL"}),
    "c9_orphan_reservations": orphans_query,
    "check_layers": check_layers_query,
}

TITLES = """titles(code, title) AS (VALUES ('E1', 'Parkeerverbod'), ('E2', 'Verbod stil te staan'),
 ('E3', 'Verbod (brom)fietsen te plaatsen'), ('E4', 'Parkeergelegenheid'), ('E5', 'Taxistandplaats'),
 ('E6', 'Gehandicaptenparkeerplaats'), ('E6a', 'Gehandicaptenparkeerplaats algemeen'),
 ('E6b', 'Gehandicaptenparkeerplaats op kenteken'), ('E7', 'Laden en lossen'), ('E8', 'Specifieke voertuigcategorie'),
 ('E9', 'Vergunninghouders'), ('E10', 'Blauwe zone'), ('E11', 'Einde blauwe zone'), ('E12', 'Park & Ride'), ('E13', 'Carpool'))"""
GEO_ID = "concat(CAST(round_even(x0 + w / 2.0, 0) AS INT), CAST(round_even(y0 + h / 2.0, 0) AS INT))"
BORD = "CASE WHEN e_type = 'E6b' THEN NULL ELSE bord END AS bord"
VIEW = f"""view AS (SELECT parkeer_id AS id, {GEO_ID} AS geo_id, buurtcode, stadsdeel, straatnaam, aantal, soort, type,
 e_type, title AS e_type_desc, {BORD}, CAST(w * h AS DOUBLE) AS oppervlak FROM spots LEFT JOIN titles ON code = e_type)"""
VIEWED = [o.CTE_SPOTS, TITLES, VIEW]

_kind = """CASE shape WHEN 0 THEN NULL WHEN 1 THEN 'MultiLineString' WHEN 5 THEN 'GeometryCollection' ELSE 'MultiPolygon' END"""
_area = "CAST(CASE shape WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 5 THEN 0 WHEN 3 THEN w * h / 2.0 ELSE w * h END AS DOUBLE)"
# The published polynomial, written out apart from the code that it checks.
_degrees = "SELECT pid, (CAST(lat AS DOUBLE) - 52.15517440) * 0.36::DOUBLE AS p, (CAST(lon AS DOUBLE) - 5.38720621) * 0.36::DOUBLE AS l"
_rd_x = """(155000 + 190094.945::DOUBLE * l - 11832.228::DOUBLE * p * l - 114.221::DOUBLE * p * p * l - 32.391::DOUBLE * l * l * l
 - 0.705::DOUBLE * p - 2.340::DOUBLE * p * p * p * l - 0.608::DOUBLE * p * l * l * l - 0.008::DOUBLE * l * l + 0.148::DOUBLE * p * p * l * l * l)"""
_rd_y = """(463000 + 309056.544::DOUBLE * p + 3638.893::DOUBLE * l * l + 73.077::DOUBLE * p * p - 157.984::DOUBLE * p * l * l
 + 59.788::DOUBLE * p * p * p + 0.433::DOUBLE * l - 6.439::DOUBLE * p * p * l * l - 0.032::DOUBLE * p * l + 0.092::DOUBLE * l * l * l * l
 - 0.054::DOUBLE * p * l * l * l * l)"""
_ids = ", ".join(f"'{i}'" for i in SELECTED_IDS.split(","))
_attrs = "stadsdeel, buurtcode, straatnaam, soort, type, aantal, e_type, bord"
_attrs_order = ", ".join(f"{c} NULLS FIRST" for c in _attrs.split(", "))
_on_day = """FROM spots LEFT JOIN (SELECT parkeer_id AS rid, soort AS re_soort, opm, bd, ed, datum FROM res WHERE datum = DATE '1998-01-06') ON rid = parkeer_id"""

ORACLE = {
    "j2_make_valid": o.with_([o.CTE_HIS], f"SELECT parkeer_id, shape, {_kind} AS geometry_kind, {_area} AS oppervlak FROM his"),
    "m1_build_spots": o.with_([o.CTE_HIS], f"""SELECT parkeer_id AS parkeer_id_md5, parkeer_id, {_attrs}, {_area} AS oppervlak
 FROM his WHERE {_kind} = 'MultiPolygon' QUALIFY row_number() OVER (PARTITION BY parkeer_id ORDER BY {_attrs_order}) = 1"""),
    "j5_centroid": o.with_([o.CTE_SPOTS], f"SELECT parkeer_id, x0 + w / 2.0 AS cx, y0 + h / 2.0 AS cy, {GEO_ID} AS geo_id FROM spots"),
    "m5_publish_spots": o.with_([o.CTE_SPOTS], f"""SELECT parkeer_id AS parkeer_id_md5, parkeer_id, {GEO_ID} AS parkeer_geo_id, {_attrs},
 CAST(w * h AS DOUBLE) AS oppervlak FROM spots"""),
    "c5_with_sign_title": o.with_([o.CTE_SPOTS, TITLES], "SELECT parkeer_id, e_type, title AS e_type_desc FROM spots LEFT JOIN titles ON code = e_type"),
    "m7_geo_spots": o.with_(VIEWED, "SELECT * FROM view"),
    "c6_spots_today": o.with_([*o.RES_LAYERS, o.CTE_SPOTS], f"""SELECT parkeer_id, re_soort, opm AS opmerkingen, CAST(bd AS VARCHAR) AS begin_datum,
 CAST(ed AS VARCHAR) AS eind_datum, CAST(datum AS VARCHAR) AS day {_on_day}"""),
    "m8_geo_spots_today": o.with_([*o.RES_LAYERS, o.CTE_SPOTS, TITLES], f"""SELECT parkeer_id AS id, buurtcode, stadsdeel, straatnaam, aantal,
 CAST(w * h AS DOUBLE) AS oppervlak, e_type, title AS e_type_desc, {BORD}, CAST(bd AS VARCHAR) AS begin_datum,
 CAST(ed AS VARCHAR) AS eind_datum, re_soort AS soort, opm AS opmerkingen, CAST(datum AS VARCHAR) AS day
 {_on_day} LEFT JOIN titles ON code = e_type"""),
    "c7_spots_at_points": o.with_([o.CTE_SPOTS, f"pts AS ({duck(POINTS_SQL)})"], """SELECT pid, min(parkeer_id) AS id FROM pts JOIN spots
 ON px > x0 AND px < x0 + w AND py > y0 AND py < y0 + h GROUP BY pid"""),
    "j8_wgs84_to_rd": f"""SELECT pid, round({_rd_x}, 3) AS x, round({_rd_y}, 3) AS y
 FROM ({_degrees} FROM ({duck(WGS84_SQL)}))""",
    "d1_dissolve_by_street": o.with_([o.CTE_SPOTS], """SELECT straatnaam, count(*) AS aantal, CAST(sum(w * h) AS DOUBLE) AS oppervlak
 FROM spots WHERE straatnaam IS NOT NULL GROUP BY straatnaam"""),
    "j9_dissolve": f"""WITH r AS ({duck(RECTANGLES_SQL)}),
cells AS (SELECT DISTINCT straatnaam, x0 + dx AS x, y0 AS y FROM r, (VALUES (0), (1)) AS d(dx))
SELECT straatnaam, aantal, oppervlak FROM (SELECT straatnaam, count(*) AS aantal FROM r GROUP BY straatnaam)
 JOIN (SELECT straatnaam, CAST(count(*) AS DOUBLE) AS oppervlak FROM cells GROUP BY straatnaam) USING (straatnaam)""",
    "f1_list_spots": o.with_(VIEWED, "SELECT id, straatnaam, e_type, e_type_desc, bord FROM view WHERE e_type = 'E8' AND id > 'P1' ORDER BY id LIMIT 100"),
    "b10_filter_spots": o.with_(VIEWED, "SELECT id, soort, aantal, type FROM view WHERE soort = 'MULDER' AND aantal = 2 AND type = 'haaks'"),
    "b11_select_ids": o.with_(VIEWED, "SELECT id, geo_id FROM view WHERE id IN (SELECT concat('P', c_custkey) FROM customer)"),
    "b15_spot_listing": o.with_(VIEWED, """SELECT concat('Parkeervak ', id, ' te ', coalesce(straatnaam, 'None')) AS _display, id, buurtcode,
 straatnaam, aantal, type, e_type, e_type_desc, bord, oppervlak FROM view"""),
    "b15_simple_listing": o.with_(VIEWED, "SELECT id, oppervlak FROM view"),
    "b11_select_ids_text": o.with_(VIEWED, f"SELECT id, geo_id FROM view WHERE id IN ({_ids})"),
    "f2_get_spot": o.with_(VIEWED, "SELECT * FROM view WHERE id = 'P7'"),
    "geosearch": o.with_([o.CTE_SPOTS, f"requests AS ({duck(REQUESTS_SQL)})", f"""pts AS (
 SELECT pid, {_rd_x} AS px, {_rd_y} AS py
 FROM ({_degrees}
  FROM requests WHERE lat IS NOT NULL AND lon IS NOT NULL)
 UNION ALL SELECT pid, CAST(x AS DOUBLE), CAST(y AS DOUBLE) FROM requests WHERE lat IS NULL AND x <> '0')"""], """SELECT pid, min(parkeer_id) AS id
 FROM pts JOIN spots ON px > x0 AND px < x0 + w AND py > y0 AND py < y0 + h GROUP BY pid"""),
    "geoselection": o.with_(VIEWED, f"""SELECT 'straat' AS keuze, count(*) AS aantal, CAST(count(*) AS INT) AS delen, sum(oppervlak) AS oppervlak
 FROM view WHERE straatnaam = 'straat 3' UNION ALL SELECT 'ids', count(*), CAST(count(*) AS INT), sum(oppervlak) FROM view WHERE id IN ({_ids})"""),
    "d8_page_count": o.with_(VIEWED, "SELECT count(*) AS count FROM view WHERE soort = 'FISCAAL'"),
    "c9_orphan_reservations": o.with_([*o.RES_LAYERS, o.CTE_SPOTS], """SELECT parkeer_id AS parkeer_id_md5, count(*) AS aantal FROM res
 WHERE parkeer_id NOT IN (SELECT parkeer_id FROM spots WHERE e_type IS NOT NULL) GROUP BY parkeer_id"""),
    "check_layers": o.with_([o.CTE_HIS, o.CTE_CAL, o.CTE_FIS, o.CTE_SPOTS], """SELECT 'count history' AS "check", count(*) AS value, true AS ok FROM his
 UNION ALL SELECT 'count spots', count(*), true FROM spots
 UNION ALL SELECT 'count reservations', count(*), true FROM fis
 UNION ALL SELECT 'enough spots', count(*), count(*) >= 20000 FROM spots
 UNION ALL SELECT 'unique spots', count(*) - count(DISTINCT parkeer_id), count(*) = count(DISTINCT parkeer_id) FROM spots
 UNION ALL SELECT 'unique reservations', count(*), count(*) = 0 FROM (SELECT k FROM fis GROUP BY k HAVING count(*) > 1)
 UNION ALL SELECT 'reserved spots published', count(DISTINCT parkeer_id), count(*) = 0 FROM fis WHERE parkeer_id NOT IN (SELECT parkeer_id FROM spots)
 UNION ALL SELECT 'spot text lengths', count(*), count(*) = 0 FROM spots WHERE length(parkeer_id) > 30 OR length(stadsdeel) > 20
  OR length(buurtcode) > 20 OR length(straatnaam) > 40 OR length(soort) > 20 OR length(type) > 20 OR length(e_type) > 5 OR length(bord) > 50
 UNION ALL SELECT 'reservation text lengths', count(*), count(*) = 0 FROM fis WHERE length(parkeer_id) > 30 OR length(opm) > 100 OR length(bron) > 100
 UNION ALL SELECT 'enough files', count(DISTINCT stadsdeel), count(DISTINCT stadsdeel) >= 8 FROM his"""),
}
