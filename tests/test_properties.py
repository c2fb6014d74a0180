"""Property tests: Column builders against plain-Python statements of the semantics.

Each example is a batch of values evaluated in one Spark job.
"""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from blotter.functions import columns as C

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

NUMERICISH = st.text(alphabet="0123456789.+-eE _\tadfx", max_size=8)
TEXTISH = st.text(alphabet="ab \t\n\x0b\x0c\r", max_size=8)


def _eval(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {typ}")
    return [r[1] for r in df.select("i", fn("x")).orderBy("i").collect()]


def py_area_key(x):
    if x is None:
        return ""
    try:
        return str(int(float(x)))
    except Exception:
        return str(x).strip()


@SETTINGS
@given(st.lists(st.one_of(st.none(), NUMERICISH), min_size=1, max_size=40))
def test_area_key_matches_python(spark, values):
    # integers beyond the bigint range are a documented deviation (they stay text)
    def in_range(v):
        try:
            return abs(int(float(v))) < 2 ** 63
        except Exception:
            return True
    values = [v for v in values if in_range(v)] or [None]
    assert _eval(spark, values, C.area_key) == [py_area_key(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), TEXTISH), min_size=1, max_size=40))
def test_norm_text_matches_regex_definition(spark, values):
    expected = [None if v is None else re.sub(r"\s+", " ", v.strip(" "), flags=re.ASCII)
                for v in values]
    assert _eval(spark, values, C.norm_text) == expected


@SETTINGS
@given(st.lists(st.one_of(st.none(), TEXTISH), min_size=1, max_size=40))
def test_blank_to_unknown(spark, values):
    expected = ["Unknown" if v is None or v.strip(" ") == "" else v.strip(" ") for v in values]
    assert _eval(spark, values, C.blank_to_unknown) == expected


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), TEXTISH), st.one_of(st.none(), TEXTISH)),
                min_size=1, max_size=30))
def test_first_label_matches_python(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)],
                               "i int, a string, b string")
    got = [r[1] for r in df.select("i", C.first_label("a", "b")).orderBy("i").collect()]
    assert got == [(a or b or "").strip() for a, b in pairs]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789 +-.", max_size=5)),
                min_size=1, max_size=40))
def test_victim_age_raw(spark, values):
    def py(v):
        try:
            a = int(v)
        except Exception:
            return None
        return a if 0 < a < 120 else None
    assert _eval(spark, values, C.victim_age_raw) == [py(v) for v in values]


@SETTINGS
@given(st.lists(st.tuples(st.dates(dt.date(1990, 1, 1), dt.date(2030, 12, 31)),
                          st.integers(-1, 2599)), min_size=1, max_size=40))
def test_occurrence_ts_matches_python(spark, rows):
    df = spark.createDataFrame(
        [(i, dt.datetime.combine(d, dt.time()), hhmm) for i, (d, hhmm) in enumerate(rows)],
        "i int, d timestamp, t int")
    got = [r[1] for r in df.select(
        "i", C.occurrence_ts("d", C.hour_of_hhmm("t"), C.minute_of_hhmm("t"))).orderBy("i").collect()]

    def py(d, t):
        h, m = t // 100, t % 100 if t >= 0 else -(-t % 100)
        if 0 <= h <= 23 and 0 <= m <= 59:
            return dt.datetime(d.year, d.month, d.day, h, m)
        return None
    assert got == [py(d, t) for d, t in rows]
