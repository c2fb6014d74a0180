"""Operator behaviour on small literal inputs: dedup, windows, joins, filters."""

import datetime as dt

from pyspark.sql import functions as F

from blotter.functions import codes
from blotter.operators import anomaly, explore, metrics, model
from blotter.operators.filters import Filters, types_predicate
from blotter.sources import schemas


def fact_rows(spark, rows):
    """Gold-shaped DataFrame from partial dicts (other columns null)."""
    recs = [tuple(r.get(c) for c in schemas.GOLD_COLUMNS) for r in rows]
    return spark.createDataFrame(recs, schemas.GOLD)


def test_dedup_latest_wins_and_ties_are_fixed(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = [
        {"dr_no": "a", "processing_datetime": t1, "area_id": "x"},
        {"dr_no": "a", "processing_datetime": t2, "area_id": "y"},
        {"dr_no": "b", "processing_datetime": t1, "area_id": "z"},
        {"dr_no": "b", "processing_datetime": t1, "area_id": "w"},
        {"dr_no": "c", "processing_datetime": None, "area_id": "n"},
        {"dr_no": "c", "processing_datetime": t1, "area_id": "m"},
    ]
    df = fact_rows(spark, rows)
    got = {r.dr_no: r.area_id for r in model.dedup_latest(df).collect()}
    assert got == {"a": "y", "b": "w", "c": "m"}
    # input order does not change the survivor
    rev = fact_rows(spark, list(reversed(rows))).repartition(3)
    assert {r.dr_no: r.area_id for r in model.dedup_latest(rev).collect()} == got


def _daily(spark, counts, start=dt.date(2024, 1, 1), skip=()):
    rows, d = [], start
    for i, n in enumerate(counts):
        if i in skip:
            d += dt.timedelta(days=1)
        for j in range(n):
            rows.append({"dr_no": f"{i}-{j}", "occurrence_date": d})
        d += dt.timedelta(days=1)
    return fact_rows(spark, rows)


def test_zscore_zero_std_flags_change(spark):
    z = anomaly.daily_zscore(_daily(spark, [5] * 7 + [9])).collect()
    assert len(z) == 1 and z[0].crime_count == 9 and z[0].rolling_std == 0.0
    assert z[0].z_score is None and z[0].is_anomaly is True
    z = anomaly.daily_zscore(_daily(spark, [5] * 8)).collect()
    assert len(z) == 1 and z[0].is_anomaly is False


def test_zscore_needs_full_window_and_is_row_based(spark):
    # a missing calendar day does not break the 7-row frame
    z = anomaly.daily_zscore(_daily(spark, [1, 2, 3, 4, 5, 6, 7, 100], skip={3})).collect()
    assert len(z) == 1 and z[0].rolling_mean == 4.0 and z[0].is_anomaly is True
    assert anomaly.daily_zscore(_daily(spark, [1] * 7)).count() == 0


def test_anomaly_spines_are_dense(spark):
    f = _daily(spark, [5] * 7 + [9])
    wk = anomaly.anomaly_by_weekday(f).collect()
    assert [r.weekday for r in wk] == codes.WEEKDAYS_SHORT
    assert sum(r.anomaly_days for r in wk) == 1
    dom = anomaly.anomaly_by_dom(f).collect()
    assert [r.day_of_month for r in dom] == list(range(1, 32))
    assert sum(r.anomaly_days for r in dom) == 1


def test_rolling_means_restart_per_type(spark):
    rows = []
    for m, n in [(1, 1), (2, 2), (3, 3), (4, 6)]:
        for j in range(n):
            for t in ["A", "B"]:
                rows.append({"dr_no": f"{t}{m}{j}", "crime_description": t,
                             "occurrence_ts": dt.datetime(2024, m, 1, 10),
                             "occurrence_date": dt.date(2024, m, 1), "year": 2024, "is_violent": False})
    f = fact_rows(spark, rows)
    s = metrics.monthly_trend_smooth(f, Filters("2024-01-01", "2024-12-31")).where(
        F.col("crime_description") == "A").orderBy("month_start").collect()
    assert [r.incidents_smooth for r in s] == [1.0, 1.5, 2.0, (2 + 3 + 6) / 3]


def test_type_filter_blank_lists(spark):
    assert types_predicate([]) is None and types_predicate([""]) is None
    f = fact_rows(spark, [{"dr_no": "1", "crime_description": "O'NEIL"},
                          {"dr_no": "2", "crime_description": "X"}])
    assert f.where(types_predicate(["O'NEIL", ""])).count() == 1


def test_area_shares_zero_for_missing_and_null(spark):
    rows = [{"dr_no": "1", "area_name": "A", "crime_code": "624", "hour_occ": 1},
            {"dr_no": "2", "area_name": "A", "crime_code": "510", "hour_occ": 12},
            {"dr_no": "3", "area_name": "B", "crime_code": "510", "hour_occ": 12},
            {"dr_no": "4", "area_name": None, "crime_code": "624", "hour_occ": 2}]
    f = fact_rows(spark, rows)
    v = {r.area_name: (r.violent_crimes, r.violent_share) for r in explore.area_violent_share(f).collect()}
    assert v == {"A": (1, 0.5), "B": (0, 0.0), None: (0, 0.0)}
    n = {r.area_name: r.night_crime_share for r in explore.area_night_share(f).collect()}
    assert n == {"A": 0.5, "B": 0.0, None: 0.0}


def test_violence_filter_excludes_null_flags(spark):
    rows = [{"dr_no": "1", "is_violent": True}, {"dr_no": "2", "is_violent": False},
            {"dr_no": "3", "is_violent": None}]
    for r in rows:
        r.update(occurrence_date=dt.date(2024, 1, 1), year=2024)
    f = fact_rows(spark, rows)
    mk = lambda v: Filters("2024-01-01", "2024-01-31", violence=v)
    assert metrics.total_incidents(f, mk(codes.VIOLENCE_ALL)).first().incidents == 3
    assert metrics.total_incidents(f, mk(codes.VIOLENCE_ONLY)).first().incidents == 1
    assert metrics.total_incidents(f, mk(codes.VIOLENCE_NONE)).first().incidents == 1
    assert metrics.total_incidents(f, mk("something else")).first().incidents == 3


def test_weapon_share_empty_is_zero(spark):
    f = fact_rows(spark, [])
    r = metrics.weapon_share(f, Filters("2024-01-01", "2024-01-31")).first()
    assert (r.with_weapon, r.total, r.weapon_share) == (0, 0, 0.0)


def test_area_map_routes_mart_or_fact(spark):
    assert not Filters("2024-01-01", "2024-01-31").uses_fact
    assert Filters("2024-01-01", "2024-01-31", violence=codes.VIOLENCE_ONLY).uses_fact
    assert Filters("2024-01-01", "2024-01-31", crime_types=("A",)).uses_fact
    assert not Filters("2024-01-01", "2024-01-31", crime_types=("",)).uses_fact

