"""Hot keys: one id / one group holding a third of all rows."""

import datetime as dt
import statistics

from blotter.operators import marts, model
from blotter.sources import schemas


def _rows(n_hot=1000, n_cold=2000):
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n_hot):
        rows.append({"dr_no": "hot", "processing_datetime": base + dt.timedelta(minutes=i),
                     "area_id": "a", "occurrence_date": dt.date(2024, 1, 1),
                     "area_name": "HOT", "reporting_delay_days": i % 37, "is_violent": i % 3 == 0})
    for i in range(n_cold):
        rows.append({"dr_no": f"c{i}", "processing_datetime": base, "area_id": "b",
                     "occurrence_date": dt.date(2024, 1, 2 + i % 20), "area_name": "COLD",
                     "reporting_delay_days": i % 11, "is_violent": False})
    return rows


def _df(spark, rows, parts=8):
    recs = [tuple(r.get(c) for c in schemas.GOLD_COLUMNS) for r in rows]
    return spark.createDataFrame(recs, schemas.GOLD).repartition(parts)


def test_hot_id_dedup_is_partial_before_shuffle(spark):
    rows = _rows()
    out = model.dedup_latest(_df(spark, rows))
    got = {r.dr_no: r for r in out.collect()}
    assert len(got) == 2001
    assert got["hot"].processing_datetime == dt.datetime(2024, 1, 1) + dt.timedelta(minutes=999)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # partial top-1 per id on the map side, then the shuffle, then the final top-1
    assert plan.count("WindowGroupLimit") >= 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_hot_group_exact_median(spark):
    rows = _rows()
    m = marts.mart_daily_area(_df(spark, rows)).where("area_name = 'HOT'").first()
    delays = [r["reporting_delay_days"] for r in rows if r["area_name"] == "HOT"]
    assert m.crime_count == 1000
    assert m.median_reporting_delay_days == statistics.median(delays)
    assert m.violent_count == sum(1 for r in rows if r["area_name"] == "HOT" and r["is_violent"])
