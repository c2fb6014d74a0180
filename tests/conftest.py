import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from blotter.session import ensure_shared_dir, local_session
    s = local_session()
    ensure_shared_dir(s)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.exists(f"{SF_SMALL}/lineitem.parquet"):
        pytest.skip("test data missing")
    return SF_SMALL


def scratch(spark, prefix):
    """A fresh folder inside the session's shared folder (spark.checkpoint.dir)."""
    import tempfile
    from blotter.session import shared_dir
    return tempfile.mkdtemp(prefix=prefix, dir=shared_dir(spark))


def bronze_rows(spark, rows):
    """Bronze DataFrame from dicts of raw text (missing keys -> null)."""
    from blotter.sources import schemas
    base = {c: None for c in schemas.BRONZE_RAW_COLUMNS}
    recs = []
    for r in rows:
        d = dict(base)
        d.update({k: v for k, v in r.items() if k in base})
        recs.append(tuple(d[c] for c in schemas.BRONZE_RAW_COLUMNS))
    df = spark.createDataFrame(recs, schemas.BRONZE_RAW)
    from pyspark.sql import functions as F
    return df.withColumns({
        "ingest_date": F.lit("2024-01-01").cast("date"),
        "processing_datetime": F.lit("2024-01-01 00:00:00").cast("timestamp"),
        "data_source": F.lit("test"),
    })


GOOD = {"dr_no": "1", "date_rptd": "2020-01-03T00:00:00.000", "date_occ": "2020-01-01T00:00:00.000",
        "time_occ": "1230", "area": "01", "area_name": "Central", "part_1_2": "1", "crm_cd": "624",
        "crm_cd_desc": "BATTERY", "vict_age": "30", "vict_sex": "M", "vict_descent": "H",
        "premis_desc": "STREET", "weapon_desc": "KNIFE", "status_desc": "IC", "lat": "34.05",
        "lon": "-118.25"}


def rec(**over):
    d = dict(GOOD)
    d.update(over)
    return d
