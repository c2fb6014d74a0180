"""Unit tests per operator on literal edge rows (FIXTURES.md §4)."""

import datetime as dt

from pyspark.sql import functions as F

from blotter.functions import columns as C
from blotter.operators import clean, model
from conftest import bronze_rows, rec


def gold_of(spark, rows):
    return model.model(clean.silver(bronze_rows(spark, rows)))


def one(spark, expr, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_time_split_and_occurrence_ts(spark):
    rows = [rec(dr_no=str(i), time_occ=t) for i, t in
            enumerate(["0000", "0005", "2359", "2400", "1275", "", "ab", None])]
    rows.append(rec(dr_no="nulldate", date_occ=None, time_occ="1230"))
    g = {r.dr_no: r for r in gold_of(spark, rows).collect()}
    assert g["0"].occurrence_ts == dt.datetime(2020, 1, 1, 0, 0)
    assert g["1"].occurrence_ts == dt.datetime(2020, 1, 1, 0, 5)
    assert g["2"].occurrence_ts == dt.datetime(2020, 1, 1, 23, 59)
    assert g["3"].hour_occ == 24 and g["3"].occurrence_ts is None
    assert g["4"].minute_occ == 75 and g["4"].occurrence_ts is None
    for k in ["5", "6", "7"]:
        assert g[k].hour_occ is None and g[k].occurrence_ts is None
    # a null date with a valid time must not become "today"
    assert g["nulldate"].occurrence_ts is None and g["nulldate"].occurrence_date is None
    assert isinstance(g["0"].hour_occ, int)


def test_victim_age_and_group(spark):
    ages = ["-1", "0", "1", "17", "18", "25", "26", "64", "65", "110", "111", "119", "120", "n/a", "12.7"]
    rows = [rec(dr_no=a, vict_age=a) for a in ages]
    g = {r.dr_no: (r.victim_age, r.victim_age_group) for r in gold_of(spark, rows).collect()}
    assert g["-1"] == (None, "Unknown") and g["0"] == (None, "Unknown")
    assert g["1"] == (1, "Child") and g["17"] == (17, "Child")
    assert g["18"] == (18, "YoungAdult") and g["25"] == (25, "YoungAdult")
    assert g["26"] == (26, "Adult") and g["64"] == (64, "Adult")
    assert g["65"] == (65, "Senior") and g["110"] == (110, "Senior")
    for a in ["111", "119", "120", "n/a", "12.7"]:
        assert g[a] == (None, "Unknown")


def test_sex_whitelist(spark):
    assert one(spark, C.victim_sex, ["M", "F", "X", "m", None]) == ["M", "F", "Unknown", "Unknown", "Unknown"]


def test_category_and_violent_flag(spark):
    rows = [rec(dr_no=str(i), part_1_2=p) for i, p in enumerate(["1", "2", "3", None, "01"])]
    g = {r.dr_no: (r.crime_category, r.is_violent) for r in gold_of(spark, rows).collect()}
    assert g == {"0": ("Violent", True), "1": ("Non-Violent", False), "2": ("Other", False),
                 "3": ("Other", False), "4": ("Other", False)}


def test_delay_and_late_flag(spark):
    days = {"m1": "2019-12-31", "d0": "2020-01-01", "d7": "2020-01-08", "d8": "2020-01-09", "dn": None}
    rows = [rec(dr_no=k, date_rptd=(v + "T00:00:00.000") if v else None) for k, v in days.items()]
    g = {r.dr_no: (r.reporting_delay_days, r.is_reported_late) for r in gold_of(spark, rows).collect()}
    assert g == {"m1": (None, None), "d0": (0, False), "d7": (7, False), "d8": (8, True), "dn": (None, None)}


def test_norm_text(spark):
    assert one(spark, C.norm_text, ["  a   b ", "\t a", None]) == ["a b", " a", None]


def test_geo_filter_and_ranges(spark):
    rows = [rec(dr_no="zz", lat="0", lon="0"), rec(dr_no="z1", lat="0", lon="-118"),
            rec(dr_no="big", lat="95.5", lon="-118"), rec(dr_no="nl", lat=None, lon="-118"),
            rec(dr_no="bad", lat="abc", lon="-118"), rec(dr_no="lon", lat="34", lon="-190")]
    g = {r.dr_no: (r.lat, r.lon) for r in gold_of(spark, rows).collect()}
    assert set(g) == {"z1", "big", "lon"}
    assert g["z1"] == (0.0, -118.0) and g["big"] == (None, -118.0) and g["lon"] == (34.0, None)


def test_has_weapon(spark):
    rows = [rec(dr_no="n", weapon_desc=None), rec(dr_no="u", weapon_desc="UNKNOWN WEAPON/OTHER WEAPON"),
            rec(dr_no="k", weapon_desc="KNIFE"), rec(dr_no="s", weapon_desc="  no   weapon ")]
    g = {r.dr_no: (r.weapon_description, r.has_weapon) for r in gold_of(spark, rows).collect()}
    assert g["n"] == ("No weapon / Unknown", False)
    assert g["u"][1] is False and g["k"][1] is True and g["s"] == ("no weapon", False)


def test_hour_bucket(spark):
    got = one(spark, C.hour_bucket, [0, 5, 6, 11, 12, 17, 18, 23, 24, None], "bigint")
    assert got == ["Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon",
                   "Evening", "Evening", "Evening", "Evening"]


def test_macro_category(spark):
    got = one(spark, C.macro_category, ["236", "624", "999", "x", None, "761", "845"])
    assert got == ["Domestic & child-related", "Violent crimes", "Other / rare", "Other / rare",
                   "Other / rare", "Weapon-related", "Legal / compliance"]


def test_blank_to_unknown(spark):
    assert one(spark, C.blank_to_unknown, ["", " ", None, " a "]) == ["Unknown", "Unknown", "Unknown", "a"]


def test_area_key(spark):
    got = one(spark, C.area_key, [None, "01", "1.0", "1.9", " abc ", "7", "nan"])
    assert got == ["", "1", "1", "1", "abc", "7", "nan"]


def test_first_label(spark):
    df = spark.createDataFrame([(" A ", "B"), ("", "B "), (None, None), ("", "")], "a string, b string")
    got = [r[0] for r in df.select(C.first_label("a", "b")).collect()]
    assert got == ["A", "B", "", ""]


def test_weekday_and_month_start(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5, 0),), (dt.datetime(2024, 3, 17, 23, 0),)], "t timestamp")
    got = df.select(C.weekday_short("t"), C.month_start("t"), C.weekday_index("t")).collect()
    assert [tuple(r) for r in got] == [("Mon", dt.date(2024, 1, 1), 0), ("Sun", dt.date(2024, 3, 1), 6)]


def test_share_guard(spark):
    df = spark.createDataFrame([(1, 4), (0, 0), (3, None)], "p bigint, t bigint")
    assert [r[0] for r in df.select(C.share("p", "t")).collect()] == [0.25, 0.0, 0.0]


def test_weekday_order(spark):
    got = one(spark, C.weekday_order, ["Mon", "Sun", "Wednesday", "Funday", None])
    assert got == [1, 7, 3, 0, None]


def test_occurrence_ts_ignores_session_zone_and_dst(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        # 1997-04-06 02:39 does not exist in that zone (spring forward); kept as recorded
        rows = [rec(dr_no="gap", date_occ="1997-04-06T00:00:00.000", time_occ="0239")]
        r = gold_of(spark, rows).first()
        assert r.occurrence_ts == dt.datetime(1997, 4, 6, 2, 39)
        assert r.date_occ == dt.datetime(1997, 4, 6, 0, 0) and r.weekday == "Sun"
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
