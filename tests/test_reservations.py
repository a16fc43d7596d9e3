import datetime as dt
import random

import pytest

from stallwise.operators.dedupe import duplicate_keys, first_per_key
from stallwise.operators.subtract import mulder_free
from stallwise.plans.reservations import (
    RESERVATION_COLUMNS,
    clamped_fiscaal_days,
    latest_approved_mulder,
    mulder_clean_layer,
    reservations_fiscaal,
    reservations_mulder,
    reservations_mulder_clean,
    union_reservations,
)

FLAGS = ["ma_vr", "ma_za", "zo", "ma", "di", "wo", "do", "vr", "za"]
HIS = (
    "parkeer_id string, soort string, kenteken string, opmerking string, begintijd1 string, eindtijd1 string, "
    "begintijd2 string, eindtijd2 string, tvm_begind date, tvm_eindd date, tvm_begint string, tvm_eindt string, "
    "tvm_opmerk string, goedkeurings_datum date, " + ", ".join(f"{f} boolean" for f in FLAGS)
)
APPROVED = dt.date(2010, 1, 1)


def history(spark, *rows):
    base = {"soort": "MULDER", "goedkeurings_datum": APPROVED, **{f: False for f in FLAGS}}
    names = [c.split()[0] for c in HIS.split(", ")]
    return spark.createDataFrame([tuple({**base, **r}.get(n) for n in names) for r in rows], HIS)


def measure(spot, first, last, begin, end, **more):
    return {"parkeer_id": spot, "soort": "FISCAAL", "tvm_begind": first, "tvm_eindd": last, "tvm_begint": begin, "tvm_eindt": end, **more}


def march(day):
    return dt.date(2010, 3, day)


def hm(h, m=0):
    return 3600 * h + 60 * m


def test_clamped_days(spark):
    his = history(
        spark,
        measure("p1", march(1), march(1), "09:00", "12:00"),
        measure("p2", march(1), march(2), "09:00", "12:00"),
        measure("p3", march(1), march(2), "09:00", "08:00"),
        measure("p4", march(1), march(4), "09:00", "09:00"),
        measure("p5", march(2), march(1), "09:00", "12:00"),
        {"parkeer_id": "p6", "tvm_begind": march(1), "tvm_eindd": march(1)},
    )
    rows = {tuple(r) for r in clamped_fiscaal_days(his, march(1), "30 days").collect()}
    assert rows == {
        ("p1", march(1), hm(9), hm(12)),
        ("p2", march(1), hm(9), 0),
        ("p2", march(2), 0, hm(12)),
        ("p3", march(1), hm(9), 0),
        ("p3", march(2), 0, hm(8)),
        ("p4", march(1), hm(9), 0),
        ("p4", march(2), 0, 0),
        ("p4", march(3), 0, 0),
        ("p4", march(4), 0, hm(9)),
    }


def test_fiscaal_passes(spark):
    his = history(
        spark,
        measure("p1", march(1), march(2), "9;00", "12:00"),
        measure("p1", march(1), march(2), "9:00", "12:00"),
        measure("p2", march(1), march(1), "x", "12:00"),
        measure("p3", march(1), march(1), "12:00", "09:00"),
        measure("p4", None, march(1), "09:00", "12:00"),
    )
    got = {(r.reserverings_key_md5, r.reservering_bron) for r in reservations_fiscaal(his, march(1), "5 days").collect()}
    assert got == {
        ("p1-2010-03-01-09:00:00-12:00:00fiscaal-tvm", "fiscaal-tvm"),
        ("p1-2010-03-02-09:00:00-12:00:00fiscaal-tvm", "fiscaal-tvm"),
        ("IDp1D2010-03-01BT09:00:00ET12:00:00FISCAAL", "tvm_fiscaal"),
        ("IDp1D2010-03-02BT09:00:00ET12:00:00FISCAAL", "tvm_fiscaal"),
        ("IDp2D2010-03-01BT00:00:00ET12:00:00FISCAAL", "tvm_fiscaal"),
    }


def test_weekly_rules(spark):
    his = history(
        spark,
        {"parkeer_id": "all", "begintijd1": "09:00", "eindtijd1": "12:00"},
        {"parkeer_id": "week", "ma_vr": True},
        {"parkeer_id": "monday", "ma": True, "begintijd2": "19:00", "eindtijd2": "21:00"},
        {"parkeer_id": "null", "zo": None},
        {"parkeer_id": "null and set", "zo": None, "di": True},
        {"parkeer_id": "unapproved", "goedkeurings_datum": None},
        {"parkeer_id": "late", "goedkeurings_datum": dt.date(2010, 1, 19)},
    )
    got = reservations_mulder(his, APPROVED, "19 days").groupBy("parkeer_id").count()
    # Twenty days from a Friday: fourteen weekdays, Mondays 4, 11 and 18, Tuesdays 5, 12 and 19.
    assert {r[0]: r[1] for r in got.collect()} == {"all": 20, "week": 14, "monday": 6, "null and set": 3, "late": 2}


def test_survivor_is_chosen_per_day(spark):
    his = history(
        spark,
        {"parkeer_id": "p", "kenteken": "A", "ma": True, "opmerking": ""},
        {"parkeer_id": "p", "kenteken": "B"},
        {"parkeer_id": "p", "kenteken": "C", "opmerking": None},
    )
    rows = reservations_mulder(his, APPROVED, "6 days").collect()
    assert len(rows) == 7
    assert {r.reserverings_datum.weekday(): r.kenteken for r in rows} == {d: "A" if d == 0 else "B" for d in range(7)}


def test_latest_approved(spark):
    his = history(
        spark,
        {"parkeer_id": "p", "goedkeurings_datum": dt.date(2009, 12, 31)},
        {"parkeer_id": "p"},
    )
    rows = latest_approved_mulder(his, dt.date(2009, 12, 31), "20 days").collect()
    assert sorted(r.reserverings_datum for r in rows)[0] == APPROVED and len(rows) == 20


def reservations(spark, kind, rows):
    """Rows of (spot, begin, end, plate)."""
    full = [
        (f"{kind}{i}", s, s, kind, k, march(1), None, None, b, e, None, None) for i, (s, b, e, k) in enumerate(rows)
    ]
    types = "string string string string string date date date int int string string".split()
    return spark.createDataFrame(full, ", ".join(f"{c} {t}" for c, t in zip(RESERVATION_COLUMNS, types)))


def text(s):
    return f"{s // 3600:02d}:{s % 3600 // 60:02d}:{s % 60:02d}"


def brute_force(mul, fis):
    """The subtraction pair by pair."""
    best = {}
    free = []

    def add(key, row):
        if key not in best or row < best[key]:
            best[key] = row

    for i, (s, b, e, k) in enumerate(mul):
        others = [f for f in fis if f[0] == s]
        if not others:
            free.append((f"MULDER{i}", s, k, b, e))
        for _, fb, fe, _ in others:
            head = f"{s}-2010-03-01-"
            if b < fb < e <= fe:
                add(f"id{s}d2010-03-01bt{text(b)}et{text(e)}mulder", (k, b, fb))
            if fb <= b <= fe <= e:
                add(f"{head}{text(fb)}-{text(fe)}-fiscaal", (k, fe, e))
            if b < fb and e > fe:
                add(f"{head}{text(b)}*{text(fb)}-m>f", (k, b, fb))
                add(f"{head}{text(fe)}*{text(e)}-m>f", (k, fe, e))
    spot_of = lambda key: key.split("d2010")[0][2:] if key.startswith("id") else key.split("-2010")[0]
    return sorted([*free, *((key, spot_of(key), k, b, e) for key, (k, b, e) in best.items())])


def test_subtraction_against_brute_force(spark):
    pick = random.Random(3)
    times = [hm(h) for h in range(8, 20)]
    # One spot holds a third of the rows; windows may be reversed.
    spot = lambda: "hot" if pick.random() < 0.35 else f"s{pick.randrange(30)}"
    mul = [(spot(), pick.choice(times), pick.choice(times), pick.choice("ABC")) for _ in range(300)]
    fis = [(spot(), pick.choice(times), pick.choice(times), None) for _ in range(60)]
    fis = [f for f in fis if f[0] not in ("s1", "s2")] * 2
    clean = reservations_mulder_clean(reservations(spark, "MULDER", mul), reservations(spark, "FISCAAL", fis))
    got = sorted((r.reserverings_key_md5, r.parkeer_id, r.kenteken, r.begin_tijd, r.eind_tijd) for r in clean.collect())
    assert got == brute_force(mul, fis)
    assert duplicate_keys(clean, "reserverings_key_md5").count() == 0


@pytest.mark.parametrize(
    "window, left",
    [
        ((9, 11), [(9, 10)]),
        ((11, 15), [(13, 15)]),
        ((11, 13), [(13, 13)]),
        ((9, 15), [(9, 10), (13, 15)]),
        ((11, 12), []),
        ((14, 15), []),
        ((8, 9), []),
    ],
)
def test_overlap_cases(spark, window, left):
    mul = reservations(spark, "MULDER", [("p", hm(window[0]), hm(window[1]), "A")])
    fis = reservations(spark, "FISCAAL", [("p", hm(10), hm(13), None)])
    rows = reservations_mulder_clean(mul, fis).collect()
    assert sorted((r.begin_tijd // 3600, r.eind_tijd // 3600) for r in rows) == left
    assert mulder_free(mul, fis).count() == 0
    assert union_reservations(fis, mul).count() == 2


def test_first_per_key_nulls_first(spark):
    d = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), ("a", 1, None), ("b", None, "y")], "k string, n int, t string")
    rows = first_per_key(d, ["k"]).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [("a", 1, None), ("b", None, "y")]
    assert first_per_key(d.select("k"), ["k"]).count() == 2


def test_rules_are_told_apart_before_they_become_days(spark):
    pick = random.Random(5)
    rows = []
    for n in range(120):
        flags = {f: pick.random() < 0.3 for f in FLAGS}
        rows.append({"parkeer_id": f"s{n % 20}", "opmerking": pick.choice([None, "", "x"]), "begintijd1": f"{8 + n % 5}:00", "eindtijd1": f"{14 + n % 7}:00", **flags})
    rows += [measure(f"s{n}", march(n + 1), march(n + 3), "10:00", "16:00") for n in range(0, 20, 3)]
    rows += [{"parkeer_id": spot, "begintijd1": "9:00", "eindtijd1": "20:00"} for spot in (None, "")]
    rows += [measure("", march(2), march(3), "10:00", "12:00"), measure(None, march(2), march(3), "10:00", "12:00")]
    his = history(spark, *rows)
    fis = reservations_fiscaal(his, march(1), "30 days")
    direct = reservations_mulder_clean(reservations_mulder(his, march(1), "30 days"), fis)
    early = mulder_clean_layer(his, fis, march(1), "30 days")
    assert early.count() > 100
    assert sorted(map(str, early.collect())) == sorted(map(str, direct.collect()))


def test_a_long_horizon_plans_no_more_shuffles(spark):
    his = history(spark, *({"parkeer_id": f"s{n}", "begintijd1": "9:00", "eindtijd1": "12:00"} for n in range(50)), measure("s3", march(1), march(2), "10:00", "11:00"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        written = []
        for horizon in ("0 days", "364 days"):
            clean = mulder_clean_layer(his, reservations_fiscaal(his, march(1), horizon), march(1), horizon)
            rows = clean.count()
            nodes = clean._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" not in nodes and rows
            written.append((rows, nodes.count("Exchange hashpartitioning(")))
        assert written[1][0] > 300 * written[0][0] and written[0][1] == written[1][1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
