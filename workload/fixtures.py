"""Inputs of the registered queries, derived from the given tables.

Each ``*_SQL`` text runs unchanged in Spark and in DuckDB, so the two start from the same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

AS_OF = dt.date(1998, 1, 1)
HORIZON = "24 days"
TODAY = dt.date(1998, 1, 6)

HIS_SQL = """
SELECT concat('P', o_custkey) AS parkeer_id, concat('sd', o_custkey % 8) AS stadsdeel,
 concat('b', o_custkey % 40) AS buurtcode, concat('straat ', o_custkey % 25) AS straatnaam,
 CASE WHEN o_orderkey % 3 = 0 THEN 'FISCAAL' ELSE 'MULDER' END AS soort,
 CASE o_orderkey % 3 WHEN 0 THEN 'langs' WHEN 1 THEN 'haaks' ELSE 'schuin' END AS type,
 CAST(1 + o_orderkey % 3 AS INT) AS aantal,
 CASE o_custkey % 16 WHEN 13 THEN 'E6a' WHEN 14 THEN 'E6b' WHEN 15 THEN NULL ELSE concat('E', 1 + o_custkey % 16) END AS e_type,
 concat('bord ', o_orderkey % 23) AS bord,
 CASE WHEN o_orderkey % 17 = 0 THEN concat('K', o_orderkey % 100) END AS kenteken,
 CASE o_orderkey % 7 WHEN 0 THEN '9:00' WHEN 1 THEN '09;30' WHEN 2 THEN 'onbekend' WHEN 3 THEN NULL
                     WHEN 4 THEN '13:00:00' WHEN 5 THEN '7:5' ELSE '08:00' END AS begintijd1,
 CASE o_orderkey % 5 WHEN 0 THEN '12:00' WHEN 1 THEN '17;30' WHEN 2 THEN '23:59:59' WHEN 3 THEN NULL ELSE '18:00' END AS eindtijd1,
 CASE WHEN o_orderkey % 11 = 0 THEN '19:00' END AS begintijd2, CASE WHEN o_orderkey % 11 = 0 THEN '21:00' END AS eindtijd2,
 o_orderkey % 4 = 0 AS ma_vr, o_orderkey % 9 = 0 AS ma_za,
 CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderkey % 10 = 0 END AS zo, o_orderkey % 13 = 1 AS ma,
 o_orderkey % 13 = 2 AS di, o_orderkey % 13 = 3 AS wo, o_orderkey % 13 = 4 AS do_, o_orderkey % 13 = 5 AS vr, o_orderkey % 13 = 6 AS za,
 CASE o_orderkey % 19 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('opm', o_orderkey % 3) END AS opmerking,
 CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS tvm_begind,
 CAST(o_orderdate AS DATE) + CAST(o_orderkey % 6 AS INT) - 1 AS tvm_eindd,
 CASE o_orderkey % 4 WHEN 0 THEN '10:00' WHEN 1 THEN 'x' WHEN 2 THEN '11;15' ELSE '14:00' END AS tvm_begint,
 CASE o_orderkey % 5 WHEN 0 THEN '12:00' WHEN 1 THEN '16:00' WHEN 2 THEN NULL ELSE '20:30' END AS tvm_eindt,
 CASE WHEN o_orderkey % 2 = 0 THEN 'werk' END AS tvm_opmerk,
 DATE '1998-01-01' + CAST(o_custkey % 3 AS INT) AS goedkeurings_datum,
 CAST(o_orderkey % 23 AS INT) AS shape,
 120000 + 10 * CAST(o_custkey % 50 AS INT) AS x0, 485000 + 10 * CAST(floor(o_custkey / 50.0) AS INT) AS y0,
 4 + CAST(o_custkey % 6 AS INT) AS w, 3 + CAST(o_custkey % 5 AS INT) AS h
FROM {orders}
"""

SPOTS_SQL = """
SELECT concat('P', p_partkey) AS parkeer_id, concat('sd', p_partkey % 8) AS stadsdeel,
 concat('b', p_partkey % 40) AS buurtcode,
 CASE WHEN p_partkey % 26 = 25 THEN NULL ELSE concat('straat ', p_partkey % 25) END AS straatnaam,
 CASE WHEN p_partkey % 3 = 0 THEN 'FISCAAL' ELSE 'MULDER' END AS soort,
 CASE p_partkey % 3 WHEN 0 THEN 'langs' WHEN 1 THEN 'haaks' ELSE 'schuin' END AS type,
 CAST(1 + p_partkey % 3 AS INT) AS aantal,
 CASE p_partkey % 16 WHEN 13 THEN 'E6a' WHEN 14 THEN 'E6b' WHEN 15 THEN NULL ELSE concat('E', 1 + p_partkey % 16) END AS e_type,
 concat('bord ', p_partkey % 7) AS bord,
 120000 + 10 * CAST(p_partkey % 50 AS INT) AS x0, 485000 + 10 * CAST(floor(p_partkey / 50.0) AS INT) AS y0,
 4 + CAST(p_partkey % 6 AS INT) AS w, 3 + CAST(p_partkey % 5 AS INT) AS h
FROM {part}
"""

POINTS_SQL = """
SELECT c_custkey AS pid, 120000 + CAST((c_custkey * 37) % 1000 AS INT) / 2.0 AS px,
 485000 + CAST((c_custkey * 91) % 900 AS INT) / 2.0 AS py
FROM {customer}
"""

WGS84_SQL = """
SELECT c_custkey AS pid, 52.0 + CAST(c_custkey % 1000 AS INT) / 2000.0 AS lat, 4.5 + CAST((c_custkey * 7) % 1000 AS INT) / 500.0 AS lon
FROM {customer}
"""

REQUESTS_SQL = """
SELECT c_custkey AS pid,
 CASE WHEN c_custkey % 4 IN (0, 2) THEN concat('52.35', 300 + (c_custkey * 37) % 400) END AS lat,
 CASE WHEN c_custkey % 4 IN (0, 2) THEN concat('4.87', 300 + (c_custkey * 91) % 700) END AS lon,
 CASE WHEN c_custkey % 8 = 3 THEN '0' WHEN c_custkey % 4 IN (1, 2) THEN concat(120000 + (c_custkey * 37) % 500, '.5') END AS x,
 CASE WHEN c_custkey % 4 > 0 AND c_custkey % 16 <> 7 THEN concat(485000 + (c_custkey * 91) % 400, '.5') END AS y
FROM {customer}
"""

RECTANGLES_SQL = """
SELECT l_returnflag AS straatnaam, CAST(l_partkey % 300 AS INT) AS x0, CAST(l_suppkey % 200 AS INT) AS y0, 2 AS w, 1 AS h
FROM {lineitem}
"""

LISTING_SQL = """
SELECT concat(CASE WHEN event_id % 5 = 0 THEN 'nietfiscaal_' ELSE 'parkeer_' END, event_id, '.zip') AS name, ts AS last_modified,
 CASE event_id % 4 WHEN 1 THEN 'application/octet-stream' WHEN 2 THEN 'text/plain' ELSE 'application/zip' END AS content_type
FROM {events}
"""

STEMS_SQL = """
SELECT concat('/data/', CASE WHEN o_orderkey % 5 = 0 THEN 'nietfiscaal/' ELSE '' END,
 CASE o_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'West' WHEN 2 THEN 'Nieuw-West' ELSE 'Centrum' END,
 '_parkeerhaven_RD_', CAST(20200100 + o_orderkey % 34 AS INT), '.shp') AS path
FROM {orders}
"""


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a fixture text over the table it names."""
    table = sql[sql.rindex("{") + 1 : sql.rindex("}")]
    return spark.sql(sql, **{table: read(spark, sf_dir, table)})


def duck(sql: str) -> str:
    """The fixture text as a DuckDB subquery."""
    return sql.replace("{", "").replace("}", "")


def shape(*points: tuple[Column, Column]) -> Column:
    """A multipolygon of one ring through the points as given."""
    ring = F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in points])
    return F.array(F.array(ring))


def rectangle() -> Column:
    x0, y0 = F.col("x0"), F.col("y0")
    x1, y1 = x0 + F.col("w"), y0 + F.col("h")
    return shape((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))


def damaged_rectangle() -> Column:
    """The rectangle in several states of repair, told apart by ``shape``."""
    x0, y0 = F.col("x0"), F.col("y0")
    x1, y1 = x0 + F.col("w"), y0 + F.col("h")
    variants = {
        1: shape((x0, y0), (x1, y0), (x0, y0)),
        2: shape((x0, y0), (x1, y0), (x1, y1), (x0, y1)),
        3: shape((x0, y0), (x1, y1), (x1, y0), (x0, y1), (x0, y0)),
        4: shape((x0, y0), (x0, y0), (x1, y0), (x1, y1), (x1, y1), (x0, y1), (x0, y0)),
        5: shape((x0, y0), (x1, y0), (x1 + 1, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)),
    }
    result = F.when(F.col("shape") == 0, None)
    for number, variant in variants.items():
        result = result.when(F.col("shape") == number, variant)
    return result.otherwise(rectangle())


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, HIS_SQL).withColumnRenamed("do_", "do")


def history_with_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(spark, sf_dir).withColumn("geom", damaged_rectangle())


def model_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spots as the business model holds them, with a clean rectangle each."""
    return derive(spark, sf_dir, SPOTS_SQL).select(
        F.col("parkeer_id").alias("parkeer_id_md5"),
        "parkeer_id",
        "stadsdeel",
        "buurtcode",
        "straatnaam",
        "soort",
        "type",
        "aantal",
        "e_type",
        "bord",
        rectangle().alias("geom"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, POINTS_SQL).select(
        "pid", F.col("px").cast("double").alias("x"), F.col("py").cast("double").alias("y")
    )


def rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, RECTANGLES_SQL).withColumn("geom", rectangle())
