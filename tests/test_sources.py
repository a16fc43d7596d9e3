import datetime as dt
import decimal
import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stallwise.functions.geometry import MULTIPOLYGON, area, tag_srid
from stallwise.operators.checks import (
    SPOT_LENGTHS,
    check_layers,
    enforced,
    expect_min_files,
    no_rows,
    orphan_reservations,
    over_length,
    row_count,
    too_long,
)
from stallwise.operators.listing import get_spot, list_spots, page_count, select_ids, simple_listing, spot_listing
from stallwise.plans.spots import SPOT_ATTRIBUTES, publish_spots
from stallwise.plans.update import derive, load, views
from stallwise.sources.history import append_history, history_rows, read_history, read_snapshots, write_history
from stallwise.sources.log import Conflict
from stallwise.sources.publish import (
    Update,
    export_geojson,
    publish,
    published,
    published_measures,
    read_published,
    remove_old,
)
from stallwise.sources.schemas import widened
from stallwise.sources.shapefile import register
from stallwise.sources.sign_types import e_types
from stallwise.sources.snapshots import latest_per_class, latest_snapshot, one_file_per_district, with_snapshot
from workload import sources
from workload.shapefile_writer import write_shapefile

FLAGS = ["ma_vr", "ma_za", "zo", "ma", "di", "wo", "do", "vr", "za"]
TEXTS = "parkeer_id buurtcode straatnaam soort type kenteken e_type bord begintijd1 eindtijd1 eindtijd2 begintijd2 opmerking tvm_begint tvm_eindt tvm_opmerk".split()
FIELDS = (
    [(t, "C", 40, 0) for t in TEXTS]
    + [("aantal", "N", 10, 0)]
    + [(f, "L", 1, 0) for f in FLAGS]
    + [("tvm_begind", "D", 8, 0), ("tvm_eindd", "D", 8, 0)]
)


def ring(x, y, w=4, h=3, clockwise=True):
    points = [(x, y), (x, y + h), (x + w, y + h), (x + w, y), (x, y)]
    return [{"x": float(a), "y": float(b)} for a, b in (points if clockwise else points[::-1])]


def record(spot, x=0.0, **more):
    row = {name: None for name, *_ in FIELDS}
    row.update({f: False for f in FLAGS})
    row.update({"parkeer_id": spot, "soort": "MULDER", "aantal": 1, "geom": [[ring(x, 0)]]})
    row.update(more)
    return row


def test_shapefile(spark, tmp_path):
    donut = [[ring(0, 0, 10, 10), ring(2, 2, 4, 4, clockwise=False)], [ring(20, 0)]]
    rows = [record("A1", straatnaam="Prins Hendrikkadé", geom=donut, tvm_begind=dt.date(2015, 2, 1), ma=True)]
    rows += [record(f"B{i}", i) for i in range(25)]
    rows.append(record("C1", geom=None, aantal=None, zo=None))
    write_shapefile(f"{tmp_path}/test_parkeerhaven_RD_20150202", FIELDS, rows)
    register(spark)
    d = spark.read.format("shapefile").option("recordsPerPartition", 10).load(str(tmp_path))
    assert d.rdd.getNumPartitions() == 3
    assert dict(d.dtypes)["aantal"] == "decimal(10,0)" and dict(d.dtypes)["tvm_begind"] == "date"
    got = {r.parkeer_id: r for r in d.withColumn("a", area(F.col("geom"))).collect()}
    assert len(got) == 27
    first = got["A1"]
    assert (first.straatnaam, first.tvm_begind, first.ma, first.aantal) == ("Prins Hendrikkadé", dt.date(2015, 2, 1), True, decimal.Decimal(1))
    assert first.a == 96 and [len(p) for p in first.geom] == [2, 1] and first.bord is None and first.tvm_eindd is None
    assert got["B24"].a == 12 and got["B24"].geom[0][0][0].x == 24
    assert got["C1"].geom is None and got["C1"].aantal is None and got["C1"].zo is None


def test_shapefile_pattern_and_errors(spark, tmp_path):
    for folder, name in (("a", "x_parkeerhaven_RD_20150202"), ("b", "y_parkeerhaven_RD_20150202")):
        write_shapefile(f"{tmp_path}/{folder}/{name}", FIELDS, [record(name[0])])
    register(spark)
    assert spark.read.format("shapefile").load(f"{tmp_path}/*/*.shp").count() == 2
    assert spark.read.format("shapefile").load(f"{tmp_path}/a/x_parkeerhaven_RD_20150202.shp").count() == 1
    with pytest.raises(PySparkException):
        spark.read.format("shapefile").load(f"{tmp_path}/none*").count()


def test_shapefile_is_written_from_a_stream(spark, tmp_path):
    """Rows are taken once, so a file needs no list of them; many are read back whole and in place."""
    fields = [("id", "C", 8, 0), ("aantal", "N", 6, 0)]
    rows = ({"id": f"A{i}", "aantal": i, "geom": [[ring(i, 0)]] if i % 7 else None} for i in range(12_345))
    assert write_shapefile(f"{tmp_path}/many", fields, rows) == 12_345
    register(spark)
    d = spark.read.format("shapefile").load(str(tmp_path))
    got = d.select("id", F.col("aantal").cast("int"), F.col("geom")[0][0][0]["x"].alias("x"), area("geom").alias("a")).collect()
    assert sorted(map(tuple, got)) == sorted((f"A{i}", i, float(i) if i % 7 else None, 12.0 if i % 7 else None) for i in range(12_345))


def test_spots_are_written_to_more_files_as_they_grow(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sources, "SPOTS_A_FILE", 30)
    monkeypatch.setattr(sources, "scratch_dir", lambda spark: f"{tmp_path}/files")
    spark.range(200).withColumnRenamed("id", "p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    assert sources.scan_shapefile(spark, str(tmp_path)).select("parkeer_id").distinct().count() == 200
    assert len(list(tmp_path.glob("files/*.shp"))) == 7


def test_shapefiles_of_differing_columns(spark, tmp_path):
    geom = [[ring(0, 0)]]
    write_shapefile(f"{tmp_path}/a", [("id", "C", 5, 0), ("aantal", "N", 6, 0)], [{"id": "a", "aantal": 12345, "geom": geom}])
    later = [("aantal", "N", 6, 2), ("bord", "C", 9, 0), ("id", "C", 7, 0)]
    write_shapefile(f"{tmp_path}/b", later, [{"id": "b", "aantal": decimal.Decimal("2.50"), "bord": "x", "geom": geom}])
    write_shapefile(f"{tmp_path}/c", [("id", "C", 5, 0)], [])
    register(spark)
    d = spark.read.format("shapefile").load(str(tmp_path))
    assert dict(d.dtypes)["aantal"] == "decimal(8,2)"
    got = {tuple(r) for r in d.select("id", "aantal", "bord").collect()}
    assert got == {("a", decimal.Decimal("12345.00"), None), ("b", decimal.Decimal("2.50"), "x")}
    assert spark.read.format("shapefile").load(f"{tmp_path}/c.shp").collect() == []
    write_shapefile(f"{tmp_path}/d", [("aantal", "C", 5, 0)], [])
    with pytest.raises(PySparkException, match="aantal"):
        spark.read.format("shapefile").load(str(tmp_path))


def test_snapshot_names(spark):
    names = {
        "/d/West_parkeerhaven_RD_20150202.shp": ("west", dt.date(2015, 2, 2)),
        "/d/_parkeerhaven_20150202.shp": ("unknown", dt.date(2015, 2, 2)),
        "/d/nietfiscaal/Nieuw-West_parkeerhaven_x_20150203.shp": ("nieuw_west_nf", dt.date(2015, 2, 3)),
        "/d/nietfiscaal_oud/Oost_parkeerhaven_20150231.shp": ("oost", None),
    }
    d = with_snapshot(spark.createDataFrame([(n,) for n in names], "path string"))
    assert {r.path: (r.stadsdeel, r.goedkeurings_datum) for r in d.collect()} == names
    assert [r.stadsdeel for r in latest_snapshot(d).collect()] == ["nieuw_west_nf"]
    twice = d.unionByName(d.withColumn("path", F.concat("path", F.lit("2"))))
    assert one_file_per_district(twice.filter("stadsdeel = 'west'")).first().path.endswith("2")
    for wrong, strict in (("/d/West_20150202.shp", False), ("/d/Oost_parkeerhaven_20150231.shp", True)):
        with pytest.raises(PySparkException):
            with_snapshot(spark.createDataFrame([(wrong,)], "path string"), strict_date=strict).collect()


def test_latest_per_class(spark):
    t = dt.datetime(2020, 1, 1)
    listing = [("a.zip", t, "application/zip"), ("b.zip", t, "application/zip"), ("new.txt", dt.datetime(2021, 1, 1), "text/plain"), ("nietfiscaal.zip", t, "application/octet-stream")]
    d = spark.createDataFrame(listing, "name string, last_modified timestamp, content_type string")
    assert {r.klasse: r.name for r in latest_per_class(d).collect()} == {"hoofd": "b.zip", "nietfiscaal": "nietfiscaal.zip"}
    with pytest.raises(PySparkException):
        latest_per_class(d.filter("name != 'nietfiscaal.zip'")).collect()


def test_history_store(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(r, "parkeer_id string, stadsdeel string, goedkeurings_datum date")
    one, two = dt.date(2015, 2, 2), dt.date(2015, 2, 3)
    path = f"{tmp_path}/his"
    write_history(rows(("a", "west", one), ("b", "oost", one)), path)
    write_history(rows(("c", "west", two), ("d", "west", two)), path)
    assert {r.parkeer_id for r in read_history(spark, path).collect()} == {"b", "c", "d"}
    path = f"{tmp_path}/dated"
    for day in (one, two, two):
        append_history(rows(("A1234", "test", day), ("A1235", "test", day)), path)
    kept = read_history(spark, path)
    assert kept.count() == 4 and kept.select("goedkeurings_datum").distinct().count() == 2


def test_publish(spark, tmp_path):
    path = f"{tmp_path}/t"
    with pytest.raises(ValueError):
        read_published(spark, path)
    assert publish(spark.range(3), path) == 1
    old = read_published(spark, path)
    assert publish(old.filter("id > 0"), path) == 2
    assert read_published(spark, path).count() == 2 and old.count() == 3


def view(spark):
    rows = [(f"P{i}", "b1" if i % 2 else "", f"s{i}" if i else None, i % 3, [[ring(i, 0)]]) for i in range(250)]
    d = spark.createDataFrame(rows, f"id string, buurtcode string, straatnaam string, aantal int, geometrie {MULTIPOLYGON}")
    return d.withColumns({c: F.lit(None).cast("string") for c in ("type", "e_type", "e_type_desc", "bord")})


def test_listing(spark, tmp_path):
    d = view(spark)
    ids, last = [], None
    while page := [r.id for r in list_spots(d, {"aantal": 1, "buurtcode": ""}, last).collect()]:
        ids, last = ids + page, page[-1]
    assert ids == sorted(f"P{i}" for i in range(250) if i % 3 == 1)
    assert page_count(d, {"aantal": 1}).first()[0] == len(ids)
    assert get_spot(d, "P7").count() == 1
    assert select_ids(d, "P1,P2, P3").count() == 2
    assert select_ids(d, spark.createDataFrame([("P1",), ("P1",), ("x",)], "id string")).count() == 1
    assert spot_listing(d).filter("id = 'P0'").first()._display == "Parkeervak P0 te None"
    assert simple_listing(d).columns == ["id", "geometrie"]
    export_geojson(d, f"{tmp_path}/json")
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/json").collect()]
    assert len(lines) == 250 and lines[0]["geometrie"]["type"] == "MultiPolygon" and "bord" in lines[0]


def test_checks(spark):
    spots = spark.createDataFrame([("a",), ("b",), ("b",)], "parkeer_id_md5 string")
    res = spark.createDataFrame([("a",), ("c",), ("c",), (None,)], "parkeer_id_md5 string")
    assert [tuple(r) for r in orphan_reservations(res, spots).collect()] == [("c", 2)]
    assert too_long(spots.withColumn("bord", F.repeat(F.lit("x"), 51)), {"bord": 50}).count() == 3
    checks = check_layers({"spots": spots}, [row_count("enough", spots, 4), no_rows("orphans", orphan_reservations(res, spots))])
    assert {r.check: (r.value, r.ok) for r in checks.collect()} == {"count spots": (3, True), "enough": (3, False), "orphans": (1, False)}
    with pytest.raises(PySparkException):
        enforced(checks).collect()
    with pytest.raises(PySparkException):
        expect_min_files(spots).collect()
    assert e_types(spark).count() == 15
    assert spots.select(tag_srid(F.col("parkeer_id_md5"), "g")).schema["g"].metadata == {"srid": 28992}


def test_whole_update(spark, tmp_path):
    main, second, store = f"{tmp_path}/in", f"{tmp_path}/in/nietfiscaal", f"{tmp_path}/store"
    day = dt.date(2015, 2, 10)
    for i, district in enumerate("abcdefgh"):
        rows = [
            record(f"{district}1", 10 * i, begintijd1="9:00", eindtijd1="17:00", e_type="E6b", bord="AB-12", aantal=2),
            record(f"{district}2", 10 * i + 5, soort="FISCAAL", tvm_begind=day, tvm_eindd=day, tvm_begint="10:00", tvm_eindt="x"),
        ]
        for date in ("20150201", "20150202"):
            write_shapefile(f"{main}/{district}_parkeerhaven_RD_{date}", FIELDS, rows[: int(date[-1])])
    write_shapefile(f"{second}/a_parkeerhaven_RD_20140101", FIELDS, [record("n1", 500, e_type="E8")])
    load(spark, store, main, second)
    his = read_history(spark, f"{store}/history")
    assert his.count() == 17 and his.filter("stadsdeel = 'a_nf'").count() == 1
    checks = derive(spark, store, day, "1 day", min_spots=17)
    assert checks.filter("not ok").count() == 0
    # Nine weekly rules on two days, eight measures on one.
    assert read_published(spark, f"{store}/reservations").count() == 18 + 8
    seen = views(spark, store, day)
    assert seen["geo_spots"].count() == 17
    today = {r.id: r for r in seen["geo_spots_today"].collect()}
    plan = seen["geo_spots_today"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reserverings_datum" in plan
    assert len(today) == 17 and today["a1"].bord is None and today["a1"].soort == "MULDER" and today["a2"].soort == "FISCAAL"
    assert today["n1"].e_type_desc == "Specifieke voertuigcategorie" and today["n1"].day == day
    with pytest.raises(PySparkException):
        derive(spark, store, day, "1 day")
    with pytest.raises(PySparkException):
        read_snapshots(spark, [second], at_least=8)


def test_checks_of_an_update_run_once(spark, tmp_path):
    """What ``derive`` returns is read from the store; the layers are not counted and grouped again for it."""
    store, day = f"{tmp_path}/store", dt.date(2015, 2, 10)
    rows = [record("a1", begintijd1="9:00", eindtijd1="17:00"), record("a2", 10.0, soort="FISCAAL", tvm_begind=day, tvm_eindd=day)]
    write_shapefile(f"{tmp_path}/in/a_parkeerhaven_RD_20150201", FIELDS, rows)
    register(spark)
    write_history(history_rows(spark.read.format("shapefile").load(f"{tmp_path}/in")), f"{store}/history")
    checks = derive(spark, store, day, "1 day", min_spots=2)
    assert {f.split("/store/")[1].split("/")[0] for f in checks.inputFiles()} == {"checks"}
    got = {r.check: (r.value, r.ok) for r in checks.collect()}
    assert got["count history"] == got["enough spots"] == (2, True) and got["unique reservations"] == (0, True) and len(got) == 17


def test_history_keeps_columns_of_some_districts(spark, tmp_path):
    path = str(tmp_path / "history")
    write_history(spark.createDataFrame([("a", 1)], "stadsdeel string, id int"), path)
    write_history(spark.createDataFrame([("b", 2, "E1")], "stadsdeel string, id int, e_type string"), path)
    rows = {r["stadsdeel"]: r["e_type"] for r in read_history(spark, path).collect()}
    assert rows == {"a": None, "b": "E1"}


def test_missing_table_counts_nothing(spark):
    rows = check_layers({"there": spark.range(2), "missing": None}, [row_count("needed", None, 1)]).collect()
    assert {r["check"]: (r["value"], r["ok"]) for r in rows} == {"count there": (2, True), "count missing": (0, True), "needed": (0, False)}


def test_history_of_two_types_reads_as_one(spark, tmp_path):
    path = str(tmp_path / "history")
    rows = lambda value, kind, district: spark.createDataFrame([(district, decimal.Decimal(value))], f"stadsdeel string, aantal {kind}")
    write_history(rows("2", "decimal(10,0)", "a"), path)
    write_history(rows("2.50", "decimal(12,2)", "b"), path)
    write_history(rows("3", "decimal(6,0)", "c"), path)
    write_history(spark.createDataFrame([("d", 4)], "stadsdeel string, AANTAL int"), path)
    back = read_history(spark, path)
    assert back.schema.simpleString() == "struct<aantal:decimal(12,2),stadsdeel:string>"
    assert {r.stadsdeel: str(r.aantal) for r in back.collect()} == {"a": "2.00", "b": "2.50", "c": "3.00", "d": "4.00"}
    assert [r.stadsdeel for r in back.filter("aantal > 2.25 and aantal < 3.5").orderBy("stadsdeel").collect()] == ["b", "c"]
    plan = back.filter("stadsdeel = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stadsdeel" in plan and len(back.filter("stadsdeel = 'a'").inputFiles()) >= 1
    with pytest.raises(ValueError, match="aantal is stored as decimal"):
        write_history(spark.createDataFrame([("d", "x")], "stadsdeel string, aantal string"), path)
    assert read_history(spark, path).count() == 4
    with pytest.raises(ValueError, match="no history"):
        read_history(spark, str(tmp_path / "none"))


def test_types_widen_as_the_scan_can_read_them(spark, tmp_path):
    samples = [
        ("tinyint", "7"), ("smallint", "300"), ("int", "70000"), ("bigint", "5000000000"), ("float", "1.5"), ("double", "2.25"),
        ("decimal(9,2)", "1.25"), ("decimal(20,4)", "3.5"), ("decimal(38,10)", "4"), ("date", "date'2020-01-01'"),
        ("timestamp_ntz", "timestamp_ntz'2020-01-01 10:00:00'"), ("string", "'x'"),
    ]
    made = []
    for i, (name, value) in enumerate(samples):
        spark.sql(f"select cast({value} as {name}) as v").coalesce(1).write.parquet(f"{tmp_path}/{i}")
        made.append(spark.read.parquet(f"{tmp_path}/{i}"))
    for i, first in enumerate(made):
        for j, second in enumerate(made[i:], i):
            wide = widened(first.schema["v"].dataType, second.schema["v"].dataType)
            assert wide == widened(second.schema["v"].dataType, first.schema["v"].dataType)
            if wide is not None and i != j:
                got = spark.read.schema(f"v {wide.simpleString()}").parquet(f"{tmp_path}/{i}", f"{tmp_path}/{j}").collect()
                want = first.select(F.col("v").cast(wide)).unionAll(second.select(F.col("v").cast(wide))).collect()
                assert sorted(got) == sorted(want), (samples[i], samples[j])


def test_snapshot_without_a_column_is_refused(spark):
    staged = spark.createDataFrame([("a", "west")], "parkeer_id string, stadsdeel string")
    with pytest.raises(ValueError, match="tvm_begind"):
        history_rows(staged)


def test_tables_of_an_update_become_current_together(spark, tmp_path):
    store = str(tmp_path / "store")
    first = Update(spark, store)
    first.write("a", spark.range(1))
    assert published(spark, store) == {}
    first.write("b", spark.range(2).withColumn("day", F.lit("x")), ["day"], {"most": F.max("id")})
    assert published(spark, store) == {} and first.measures() == {"a": {"rows": 1}, "b": {"rows": 2, "most": 1}}
    assert first.commit() == 1
    second, third = Update(spark, store), Update(spark, store)
    assert second.write("a", spark.range(10)).count() == 10
    counts = lambda version=None: {n: d.count() for n, d in published(spark, store, version).items()}
    assert counts() == {"a": 1, "b": 2}
    third.write("b", spark.range(20))
    assert second.commit() == 2 and counts() == {"a": 10, "b": 2} and counts(1) == {"a": 1, "b": 2}
    with pytest.raises(Conflict):
        third.commit()
    assert counts() == {"a": 10, "b": 2} and published_measures(spark, store)["b"]["rows"] == 2
    with pytest.raises(ValueError):
        second.write("a", spark.range(1))
    running = Update(spark, store)
    running.write("a", spark.range(3))
    # The first "a" and what the refused update wrote go; the running update's table and "b", still current, stay.
    assert [o.split("/")[0] for o in remove_old(spark, store, keep=1)] == ["a", "b"]
    assert counts() == {"a": 10, "b": 2} and running.commit() == 3 and counts() == {"a": 3, "b": 2}
    assert not [n for n in os.listdir(f"{store}/_commits") if n.endswith(".tmp")]


def test_failed_update_leaves_the_store(spark, tmp_path):
    store = str(tmp_path / "store")
    publish(spark.range(5), f"{store}/a")
    failing = Update(spark, store)
    failing.write("a", spark.range(6))
    with pytest.raises(PySparkException):
        failing.write("b", spark.range(1).select(F.raise_error(F.lit("no")).alias("x")))
    assert {n: d.count() for n, d in published(spark, store).items()} == {"a": 5}


def test_lengths_are_counted_while_a_table_is_written(spark, tmp_path):
    update = Update(spark, str(tmp_path / "store"))
    rows = spark.createDataFrame([("x" * 51, "E1"), ("x" * 50, "E13bis"), (None, None), ("", "E1")], "bord string, e_type string")
    over = over_length(rows.columns, SPOT_LENGTHS)
    update.write("spots", rows.repartition(3), measures={"too_long": F.count_if(over)})
    update.write("none", rows.limit(0), measures={"too_long": F.count_if(over)})
    assert update.measures() == {"spots": {"rows": 4, "too_long": 2}, "none": {"rows": 0, "too_long": 0}}
    checks = check_layers({"spots": 4}, [no_rows("lengths", 2), row_count("enough", 4, 4)]).collect()
    assert [(r.value, r.ok) for r in checks] == [(4, True), (2, False), (4, True)]


def test_published_geometry_names_its_reference_system(spark, tmp_path):
    spots = spark.createDataFrame([("P1", [[ring(0, 0)]])], f"parkeer_id string, geom {MULTIPOLYGON}")
    spots = spots.withColumns({c: F.lit(None).cast("string") for c in SPOT_ATTRIBUTES}).withColumn("parkeer_id_md5", F.col("parkeer_id"))
    publish(publish_spots(spots), str(tmp_path / "spots"))
    back = read_published(spark, str(tmp_path / "spots")).schema
    assert back["geom"].metadata == back["geo_id"].metadata == {"srid": 28992}
