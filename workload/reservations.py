"""Registered reservation queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stallwise.functions.keys import HISTORY_KEY, md5_key, natural_key, revalidated
from stallwise.operators.calendar import history_calendar
from stallwise.operators.dedupe import duplicate_keys, first_per_key
from stallwise.operators.fiscaal import expand_fiscaal, fiscaal_rules
from stallwise.operators.mulder import expand_mulder, merge_rules, mulder_windows
from stallwise.operators.subtract import (
    mulder_free,
    mulder_split,
    mulder_trim_left,
    mulder_trim_right,
)
from stallwise.plans.reservations import (
    clamped_fiscaal_days,
    latest_approved_mulder,
    mulder_clean_layer,
    published_reservations,
    reservations_fiscaal,
    reservations_mulder,
    union_reservations,
)
from workload import oracle as o
from workload.fixtures import AS_OF, HORIZON, history

TIME_COLUMNS = ["begintijd1", "eindtijd1", "begintijd2", "eindtijd2", "tvm_begint", "tvm_eindt"]


def plain(d: DataFrame) -> DataFrame:
    """Dates as text, so both engines return the same value."""
    return d.select(*[F.col(f.name).cast("string").alias(f.name) if f.dataType.typeName() == "date" else F.col(f.name) for f in d.schema])


def _fis(spark: SparkSession, sf: str) -> DataFrame:
    return reservations_fiscaal(history(spark, sf), AS_OF, HORIZON)


def _mul(spark: SparkSession, sf: str) -> DataFrame:
    return reservations_mulder(history(spark, sf), AS_OF, HORIZON)


MULDER_OUT = ["reserverings_key_md5", "parkeer_id", "kenteken", "reserverings_datum", "begin_tijd", "eind_tijd", "opmerkingen", "reservering_bron"]


def _clean(d: DataFrame) -> DataFrame:
    return plain(d.select(*MULDER_OUT))


def history_keys(spark: SparkSession, sf: str) -> DataFrame:
    his = history(spark, sf)
    return his.select(
        natural_key(HISTORY_KEY).alias("parkeervak_id"),
        md5_key().alias("parkeervak_id_md5"),
        *[c.alias(n) for n, c in revalidated(TIME_COLUMNS).items()],
    )


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    return plain(history_calendar(history(spark, sf), AS_OF, HORIZON))


def expanded_fiscaal(spark: SparkSession, sf: str) -> DataFrame:
    his = history(spark, sf)
    return plain(expand_fiscaal(fiscaal_rules(his, AS_OF, HORIZON), AS_OF, HORIZON).drop("key_head", "key_tail"))


def windows(spark: SparkSession, sf: str) -> DataFrame:
    w = mulder_windows(history(spark, sf))
    return plain(w.select("parkeer_id", "kenteken", "opmerkingen", "goedkeurings_datum", "begin_tijd", "eind_tijd"))


def expanded_mulder(spark: SparkSession, sf: str) -> DataFrame:
    rules = merge_rules(mulder_windows(history(spark, sf)))
    return plain(expand_mulder(rules, AS_OF, HORIZON).drop("reserverings_key_md5"))


def first_rule_per_spot(spark: SparkSession, sf: str) -> DataFrame:
    his = history(spark, sf).select("parkeer_id", "kenteken", "opmerking", "tvm_begint", "aantal")
    return first_per_key(his, ["parkeer_id"], ["aantal"])


def doubled_keys(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_keys(history(spark, sf).select(natural_key("{parkeer_id}-{tvm_begint}").alias("sleutel")), "sleutel")


def union_summary(spark: SparkSession, sf: str) -> DataFrame:
    both = union_reservations(_fis(spark, sf), _mul(spark, sf))
    return plain(both.groupBy("soort", "reserverings_datum").agg(F.count(F.lit(1)).alias("aantal"), F.sum("begin_tijd").alias("begin_som")))


RES_OUT = """k AS reserverings_key_md5, parkeer_id, parkeer_id AS parkeer_id_md5, soort, kenteken,
 CAST(datum AS VARCHAR) AS reserverings_datum, CAST(bd AS VARCHAR) AS begin_datum, CAST(ed AS VARCHAR) AS eind_datum,
 b AS begin_tijd, e AS eind_tijd, opm AS opmerkingen, bron AS reservering_bron"""
CLEAN_OUT = """k AS reserverings_key_md5, parkeer_id, kenteken, CAST(datum AS VARCHAR) AS reserverings_datum,
 b AS begin_tijd, e AS eind_tijd, opm AS opmerkingen, bron AS reservering_bron"""
PAIRED = [o.CTE_HIS, o.CTE_CAL, o.CTE_FIS, o.CTE_MUL]

QUERIES = {
    "b3_history_keys": history_keys,
    "a12_calendar": calendar,
    "c1_expand_fiscaal": expanded_fiscaal,
    "g1_mulder_windows": windows,
    "c2_expand_mulder": expanded_mulder,
    "c3_mulder_free": lambda s, d: _clean(mulder_free(_mul(s, d), _fis(s, d))),
    "c4a_mulder_trim_left": lambda s, d: _clean(mulder_trim_left(_mul(s, d), _fis(s, d))),
    "c4b_mulder_trim_right": lambda s, d: _clean(mulder_trim_right(_mul(s, d), _fis(s, d))),
    "c4c_mulder_split": lambda s, d: _clean(mulder_split(_mul(s, d), _fis(s, d))),
    "d3_first_per_key": first_rule_per_spot,
    "d7_duplicate_keys": doubled_keys,
    "m2_reservations_fiscaal": lambda s, d: plain(_fis(s, d)),
    "m3_reservations_mulder": lambda s, d: plain(_mul(s, d)),
    "m4_reservations_mulder_clean": lambda s, d: _clean(mulder_clean_layer(history(s, d), _fis(s, d), AS_OF, HORIZON)),
    "m6_publish_reservations": lambda s, d: plain(published_reservations(history(s, d), AS_OF, HORIZON)),
    "g2_union_reservations": union_summary,
    "n1_clamped_fiscaal_days": lambda s, d: plain(clamped_fiscaal_days(history(s, d), AS_OF, HORIZON)),
    "n2_latest_approved_mulder": lambda s, d: _clean(latest_approved_mulder(history(s, d), AS_OF, HORIZON)),
}

_valid = ", ".join(f"CASE WHEN {o.ok(c)} THEN {c} END AS {c}" for c in TIME_COLUMNS)
ORACLE = {
    "b3_history_keys": o.with_([o.CTE_HIS], f"""SELECT concat(parkeer_id, '-', tvm_begind, '-', tvm_begint) AS parkeervak_id,
 md5(concat(parkeer_id, '-', tvm_begind, '-', tvm_begint)) AS parkeervak_id_md5, {_valid} FROM his"""),
    "a12_calendar": o.with_([o.CTE_HIS, o.CTE_CAL], """SELECT CAST(datum AS VARCHAR) AS datum, CAST(dag AS INT) AS dag
 FROM cal JOIN (SELECT DISTINCT goedkeurings_datum FROM his) ON true"""),
    "c1_expand_fiscaal": o.with_([o.CTE_HIS, o.CTE_CAL, o.CTE_FIS], """SELECT parkeer_id, CAST(bd AS VARCHAR) AS begin_datum,
 CAST(ed AS VARCHAR) AS eind_datum, b AS begin_tijd, e AS eind_tijd, opm AS opmerkingen,
 CAST(datum AS VARCHAR) AS reserverings_datum, bron AS reservering_bron FROM fis"""),
    "g1_mulder_windows": o.with_([o.CTE_HIS, o.CTE_CAL, o.CTE_MUL], """SELECT parkeer_id, kenteken, opmerking AS opmerkingen,
 CAST(goedkeurings_datum AS VARCHAR) AS goedkeurings_datum, b AS begin_tijd, e AS eind_tijd FROM windows"""),
    "c2_expand_mulder": o.with_([o.CTE_HIS, o.CTE_CAL, o.CTE_MUL], f"""SELECT parkeer_id, kenteken, opm AS opmerkingen,
 CAST(datum AS VARCHAR) AS reserverings_datum, b AS begin_tijd, e AS eind_tijd, CAST(goedkeurings_datum AS VARCHAR) AS goedkeurings_datum
 FROM (SELECT parkeer_id, kenteken, opmerking AS opm, datum, b, e, goedkeurings_datum,
   row_number() OVER (PARTITION BY parkeer_id, datum, b, e, coalesce(opmerking, ''), goedkeurings_datum
    ORDER BY kenteken NULLS FIRST, opmerking NULLS FIRST) AS rn
  FROM windows JOIN cal ON {o.MUL_ON}) WHERE rn = 1"""),
    "c3_mulder_free": o.with_(PAIRED, f"SELECT {CLEAN_OUT} FROM ({o.FREE})"),
    "c4a_mulder_trim_left": o.with_(PAIRED, f"SELECT {CLEAN_OUT} FROM ({o.TRIM_LEFT})"),
    "c4b_mulder_trim_right": o.with_(PAIRED, f"SELECT {CLEAN_OUT} FROM ({o.TRIM_RIGHT})"),
    "c4c_mulder_split": o.with_(PAIRED, f"SELECT {CLEAN_OUT} FROM ({o.SPLIT})"),
    "d3_first_per_key": o.with_([o.CTE_HIS], """SELECT parkeer_id, kenteken, opmerking, tvm_begint, aantal FROM his
 QUALIFY row_number() OVER (PARTITION BY parkeer_id ORDER BY aantal, kenteken NULLS FIRST, opmerking NULLS FIRST, tvm_begint NULLS FIRST) = 1"""),
    "d7_duplicate_keys": o.with_([o.CTE_HIS], """SELECT concat(parkeer_id, '-', tvm_begint) AS sleutel, count(*) AS aantal
 FROM his GROUP BY 1 HAVING count(*) > 1"""),
    "m2_reservations_fiscaal": o.with_([o.CTE_HIS, o.CTE_CAL, o.CTE_FIS], f"""SELECT {RES_OUT}
 FROM (SELECT *, 'FISCAAL' AS soort, CAST(NULL AS VARCHAR) AS kenteken FROM fis)"""),
    "m3_reservations_mulder": o.with_([o.CTE_HIS, o.CTE_CAL, o.CTE_MUL], f"""SELECT {RES_OUT}
 FROM (SELECT *, 'MULDER' AS soort, CAST(NULL AS DATE) AS bd, CAST(NULL AS DATE) AS ed, CAST(NULL AS VARCHAR) AS bron FROM mul)"""),
    "m4_reservations_mulder_clean": o.with_([*PAIRED, o.CTE_CLEAN], f"SELECT {CLEAN_OUT} FROM clean"),
    "m6_publish_reservations": o.with_(o.RES_LAYERS, f"SELECT {RES_OUT} FROM res"),
    "g2_union_reservations": o.with_(PAIRED, """SELECT soort, CAST(datum AS VARCHAR) AS reserverings_datum, count(*) AS aantal,
 CAST(sum(b) AS BIGINT) AS begin_som FROM (SELECT 'FISCAAL' AS soort, datum, b FROM fis UNION ALL SELECT 'MULDER', datum, b FROM mul) GROUP BY ALL"""),
    "n1_clamped_fiscaal_days": o.with_([o.CTE_HIS, o.CTE_CAL, o.CTE_FIS], """SELECT DISTINCT parkeer_id, CAST(datum AS VARCHAR) AS reserverings_datum,
 CASE WHEN datum = bd THEN b ELSE 0 END AS begin_tijd, CASE WHEN datum = ed THEN e ELSE 0 END AS eind_tijd FROM ruledays"""),
    "n2_latest_approved_mulder": o.with_(
        [o.CTE_HIS, o.CTE_CAL, "newest AS (SELECT * FROM his WHERE goedkeurings_datum = (SELECT max(goedkeurings_datum) FROM his))", o.cte_mul("newest")],
        f"SELECT {CLEAN_OUT} FROM (SELECT *, CAST(NULL AS VARCHAR) AS bron FROM mul)"),
}
