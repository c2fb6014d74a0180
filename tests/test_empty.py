"""Every fact-level operator runs on an empty fact (no division by zero, no empty-window errors)."""

import pytest

from blotter.functions import codes
from blotter.operators import anomaly, areas, explore, marts, metrics, quality
from blotter.operators.filters import Filters, default_period
from blotter.sources import adapter, schemas

F_ALL = Filters("2024-01-01", "2024-12-31")
F_SOME = Filters("2024-01-01", "2024-12-31", violence=codes.VIOLENCE_ONLY,
                 crime_types=("X",), area_id="01")


@pytest.fixture(scope="module")
def empty(spark):
    fact = spark.createDataFrame([], schemas.GOLD)
    return fact, marts.mart_daily_area(fact)


OPS = {
    "marts": lambda f, m: [b(f) for b in marts.MARTS.values()],
    "quality": lambda f, m: [quality.null_profile(f), quality.geo_coverage(f), quality.gold_counts(f)],
    "explore": lambda f, m: [explore.fact_span(f), explore.daily_counts(f), explore.hourly_counts(f),
                             explore.hour_bucket_dist(f), explore.hourly_category_pivot(f),
                             explore.category_list(f), explore.code_freq(f),
                             explore.macro_distribution(f), explore.other_share(f),
                             explore.other_breakdown(f), explore.area_summary(f),
                             explore.area_violent_share(f), explore.area_night_share(f),
                             explore.area_share_top10_flagged(f), explore.type_reporting_delay(f),
                             explore.type_stats(f), explore.night_leaning(f),
                             explore.night_fast_report(f), explore.night_slow_report(f),
                             explore.type_stats_top10(f)],
    "anomaly": lambda f, m: [anomaly.daily_zscore(f), anomaly.daily_anomalies(f),
                             anomaly.top_anomalies(f), anomaly.anomaly_by_weekday(f),
                             anomaly.anomaly_by_dom(f)],
    "metrics": lambda f, m: [metrics.date_bounds(m), default_period(m),
                             metrics.map_agg_mart(m, "2024-01-01", "2024-12-31"),
                             metrics.top_types(f, F_ALL), metrics.map_agg_fact(f, F_SOME),
                             metrics.area_map(f, m, F_ALL), metrics.area_map(f, m, F_SOME),
                             metrics.area_daily_series(f, F_SOME), metrics.area_top_types(f, F_SOME),
                             metrics.monthly_trend(f, F_SOME), metrics.monthly_trend_topn(f, F_ALL),
                             metrics.weekday_hour(f, F_ALL), metrics.weekday_hour_matrix(f, F_ALL),
                             metrics.area_list(m), metrics.monthly_total(f, F_ALL),
                             metrics.monthly_total_smooth(f, F_ALL),
                             metrics.monthly_trend_smooth(f, F_ALL), metrics.total_incidents(f, F_ALL),
                             metrics.dist_sex(f, F_ALL), metrics.dist_age_group(f, F_ALL),
                             metrics.dist_descent(f, F_ALL), metrics.weapon_share(f, F_ALL),
                             metrics.top_weapons(f, F_ALL), metrics.top_premises(f, F_ALL)],
    "areas": lambda f, m: [areas.area_map_geo(metrics.area_map(f, m, F_ALL),
                                              adapter.area_collections(f)
                                              .selectExpr("'' AS area_id", "'' AS area_name",
                                                          "value AS geojson"))],
}


@pytest.mark.parametrize("group", sorted(OPS))
def test_operators_run_on_empty_fact(empty, group):
    fact, mart = empty
    for df in OPS[group](fact, mart):
        df.collect()


def test_empty_dense_calendars_are_zero(empty):
    fact, _ = empty
    wk = anomaly.anomaly_by_weekday(fact).collect()
    assert [r.weekday for r in wk] == codes.WEEKDAYS_SHORT and all(r.anomaly_days == 0 for r in wk)
    assert anomaly.anomaly_by_dom(fact).count() == 31
