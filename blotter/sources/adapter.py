"""Incident-shaped bronze records derived from the test star schema.

The test data holds no incident records, so raw records are *derived* from
``lineitem ⋈ orders ⋈ supplier ⋈ nation ⋈ part`` with deterministic rules that
exercise every cleaning branch (null/bad dates, hour 24, ``n/a`` ages, blank
descents, (0, 0) coordinates, duplicate ids with tied timestamps, ...).
The same rules are written in SQL in ``plans/oracle.py`` for the DuckDB check.
Every joined line item becomes one record: the modulo rules below only derive
field values (which record gets a null date, a blank descent, ...); no row is
filtered out.

The area polygons and the raw landing files that the queries read are derived here too.

Scale notes: the join order is fact-first and every join is left to
Catalyst/AQE, which broadcasts a side only when its size (statistics, then the
measured runtime size) is under the threshold — ``nation``, 25 rows, always is —
and otherwise sort-merges on the key, splitting hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import sliced, slices_of
from . import files

TABLES = ["lineitem", "orders", "supplier", "nation", "part"]

# Crime code assigned to each part size 1..50 (position = size).
CODE_BY_SIZE = (
    626, 236, 901, 812, 121, 122, 815, 624, 230, 210, 110, 510, 520, 330, 310,
    440, 442, 420, 480, 740, 354, 662, 649, 653, 951, 347, 661, 940, 888, 886,
    933, 437, 438, 439, 949, 353, 432, 926, 845, 904, 942, 944, 948, 924, 761,
    756, 931, 999, 998, 997,
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _lpad(c: Column, n: int) -> Column:
    """Zero-padded to ``n`` characters; longer text is kept whole."""
    return F.lpad(_s(c), F.greatest(F.lit(n), F.length(_s(c))), "0")


def bronze_from_star(spark: SparkSession, sf_dir: str, ingest_date: str = "2024-01-01",
                     line_items: DataFrame | None = None) -> DataFrame:
    """Bronze-shaped rows (all text + lineage) derived from the star schema, or from some of its
    line items."""
    # a table may come as one file with one row group, which one task reads: deal its rows out,
    # at any size, by a key that no group of rows shares
    li = read_table(spark, sf_dir, "lineitem") if line_items is None else line_items
    li = li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"
    ).repartition("l_orderkey", "l_linenumber")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    su = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    pa = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")

    # no hint: the planner broadcasts nation from its size statistics (25 rows) and
    # would shuffle-join it if it were ever above the broadcast threshold
    supp_nation = su.join(na, su.s_nationkey == na.n_nationkey)
    j = (li.join(od, li.l_orderkey == od.o_orderkey)
           .join(supp_nation, li.l_suppkey == supp_nation.s_suppkey)
           .join(pa, li.l_partkey == pa.p_partkey))

    ok, pk, sk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    odate = F.col("o_orderdate").cast("date")
    size = F.col("p_size")

    hour = F.when((size % 5 == 0) & (ok % 2 == 0), ok % 6).otherwise((pk * 37 + ln * 11) % 25)
    hhmm = hour * 100 + (sk * 7 + ok) % 60
    delay = ((ok * 7 + ln * 13) % 40 - 3).cast("int")

    return j.select(
        F.concat(_s(ok), F.lit("-"), _s(ln)).alias("dr_no"),
        F.concat(_s(F.date_add(odate, delay)), F.lit("T00:00:00.000")).alias("date_rptd"),
        F.when(ok % 503 == 0, F.lit(None))
         .otherwise(F.concat(_s(odate), F.lit("T00:00:00.000"))).alias("date_occ"),
        F.when(pk % 211 == 0, F.lit(None)).otherwise(_lpad(hhmm, 4)).alias("time_occ"),
        _lpad(F.col("n_nationkey"), 2).alias("area"),
        F.when(F.col("n_nationkey") == 24, F.lit(None))
         .otherwise(F.concat(F.lit("  "), F.replace(F.col("n_name"), F.lit("_"), F.lit("   ")),
                             F.lit(" "))).alias("area_name"),
        _lpad(sk % 100, 4).alias("rpt_dist_no"),
        F.when(F.col("l_returnflag") == "A", F.lit("1"))
         .when(F.col("l_returnflag") == "N", F.lit("2"))
         .otherwise(F.lit("3")).alias("part_1_2"),
        F.get(F.array(*[F.lit(str(c)) for c in CODE_BY_SIZE]), size - 1).alias("crm_cd"),
        F.when(pk % 301 == 0, F.lit(None))
         .otherwise(F.concat(F.col("p_type"), F.lit("  TYPE "), _s(size),
                             F.when(pk % 97 == 0, F.lit(" (RARE)")).otherwise(F.lit(""))))
         .alias("crm_cd_desc"),
        F.when(ok % 13 == 0, F.lit("n/a")).otherwise(_s((pk + ok) % 130 - 5)).alias("vict_age"),
        F.when(ok % 11 == 0, F.lit(None)).when(ok % 5 == 0, F.lit("X"))
         .when(ok % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("vict_sex"),
        F.when(ok % 17 == 0, F.lit(None)).when(ok % 19 == 0, F.lit(" "))
         .otherwise(F.substr(F.lit("ABCHW"), (F.lit(1) + ok % 5).cast("int"), F.lit(1)))
         .alias("vict_descent"),
        F.when(pk % 23 == 0, F.lit(None)).otherwise(F.col("p_brand")).alias("premis_desc"),
        F.when(ln == 1, F.lit(None)).when(ln == 2, F.lit("UNKNOWN WEAPON/OTHER WEAPON"))
         .when(ln == 3, F.lit("HAND  GUN")).when(ln == 4, F.lit("KNIFE"))
         .otherwise(F.concat(F.lit("STRONG-ARM "), _s(ln))).alias("weapon_desc"),
        F.when(F.col("l_linestatus") == "O", F.lit("Invest Cont")).alias("status_desc"),
        F.when(sk % 10 == 9, F.lit("0")).when(sk % 10 == 8, F.lit(None))
         .when(sk % 10 == 7, F.lit("95.5"))
         .otherwise(F.concat(F.lit("34."), _lpad(sk % 60, 2))).alias("lat"),
        F.when(sk % 10 == 9, F.lit("0"))
         .otherwise(F.concat(F.lit("-118."), _lpad(ok % 50, 2))).alias("lon"),
        F.lit(ingest_date).cast("date").alias("ingest_date"),
        F.date_add(F.lit("2000-01-01").cast("date"), pk.cast("int"))
         .cast("timestamp").alias("processing_datetime"),
        F.lit("star-schema adapter").alias("data_source"),
        F.lit(None).cast("variant").alias("extra"),
    )


def bronze_slices(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The rows of ``bronze_from_star`` in slices of orders: the joins of one slice are shuffled at a time."""
    slices = slices_of(files.size(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in TABLES]))
    return [bronze_from_star(spark, sf_dir, line_items=li)
            for li in sliced(read_table(spark, sf_dir, "lineitem"), slices, F.xxhash64("l_orderkey"))]


# --- raw landing files ------------------------------------------------------------
def _okey() -> Column:
    return F.substring_index("dr_no", "-", 1).cast("long")


def landing_files(bronze: DataFrame, size: int = 0) -> list[tuple[DataFrame, bool]]:
    """Raw records in the four layouts of page files, a quarter of the orders in each: texts
    (column ``value``), and whether each text is a file of its own.

    Arrays with the comma at the end of the line, in which some lines are cut off (a record of
    its own, lost); arrays with the comma at the start of the line; arrays on one line;
    pretty-printed pages, one for each year (and range of orders). Some records carry a key
    that is not declared. The texts that are put together from several records come in slices, given
    the ``size`` of the bronze layer in bytes.
    """
    raw = bronze.drop("ingest_date", "processing_datetime", "data_source", "extra")
    more = F.when((_okey() % 51 == 0) & F.col("dr_no").endswith("-1"), F.struct(
        F.lit("cross street").alias("street"), _okey().alias("number"))).alias("location_2")
    record = F.struct(*raw.columns, more)
    text, part = F.to_json(record), _okey() % 4
    rows = raw.select(text.alias("text"), part.alias("part"), "dr_no", "date_occ", _okey().alias("okey"))
    cut = F.when(F.col("dr_no").endswith("00-2"), F.substring("text", 1, 40))
    ends = rows.where("part = 0").select(F.explode(F.filter(F.array(
        F.concat(F.lit("["), "text", F.lit(",")), cut, F.lit("]")), lambda x: x.isNotNull())).alias("value"))
    starts = rows.where("part = 1").select(
        F.when(F.col("okey") % 20 == 1, F.concat(F.lit("["), "text"))
        .when(F.col("okey") % 20 == 5, F.concat(F.lit("  , "), "text", F.lit(" ]")))
        .otherwise(F.concat(F.lit(","), "text")).alias("value"))
    def each(n: int, orders: int) -> list[DataFrame]:  # the records of layout n
        number = F.expr(f"cast(substring_index(dr_no, '-', 1) AS BIGINT) div {orders}")
        return sliced(raw.where(part == n), slices_of(size // 4), number)

    one = [r.select(text.alias("text"), _okey().alias("okey")).groupBy(F.expr("okey div 32"))
           .agg(F.collect_list("text").alias("texts"))
           .select(F.concat(F.lit("["), F.array_join("texts", ", "), F.lit("]")).alias("value")) for r in each(2, 32)]
    pages = [r.select(F.to_json(record, {"pretty": "true"}).alias("text"), F.substring("date_occ", 1, 4).alias("year"),
                      _okey().alias("okey")).groupBy("year", F.expr("okey div 100000"))
             .agg(F.collect_list("text").alias("texts"))
             .select(F.concat(F.lit("[\n"), F.array_join("texts", ",\n"), F.lit("\n]")).alias("value"))
             for r in each(3, 100000)]
    return [(ends, False), (starts, False), *[(r, False) for r in one], *[(p, True) for p in pages]]


def later_batches(bronze: DataFrame) -> list[DataFrame]:
    """Batches that follow the bronze layer: changed records and, in a second one, late (older)
    versions and versions of equal time. Records that the first run dropped get coordinates."""
    when = lambda days: F.col("processing_datetime") + F.make_dt_interval(F.lit(days))
    changed = bronze.where(_okey() % 7 == 0).withColumns({
        "processing_datetime": when(10), "part_1_2": F.lit("1"), "area": _lpad(_okey() % 21, 2),
        "date_occ": F.concat(F.substring("date_occ", 1, 8), F.lit("15T00:00:00.000")),
        "lat": F.lit("34.5"), "lon": F.lit("-118.25")})
    late = bronze.where(_okey() % 11 == 0).withColumns({
        "processing_datetime": when(-10), "crm_cd_desc": F.lit("LATE"), "lat": F.lit("34.5"), "lon": F.lit("-118.25")})
    tied = bronze.where(_okey() % 13 == 0).withColumns({"weapon_desc": F.lit("AXE"), "area": F.lit("05")})
    return [changed, late.unionByName(tied)]


# --- area polygons ----------------------------------------------------------------
# Area keys with a special feature in the derived collections.
NULL_PREC_AREA = 23
NO_LABEL_AREA = 21


def _jstr(c) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def area_collections(fact: DataFrame) -> DataFrame:
    """GeoJSON FeatureCollection texts (column ``value``), one for each area of the fact.

    An area's polygon is the bounding box of its incidents' valid coordinates (one
    aggregation, partial per task). The feature properties follow rules on the area key
    so every branch of the key normaliser is hit: ``prec`` as ``8``, ``5.0``, ``"06"``,
    ``"7"`` or null, other keys as they are; ``aprec`` empty (falls back to ``name``),
    padded, or missing; one area without labels.
    """
    k = F.col("area_id").try_cast("int")
    boxes = (fact.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()
                        & F.col("area_id").isNotNull())
                 .groupBy("area_id")
                 .agg(F.min("lat").alias("y0"), F.max("lat").alias("y1"),
                      F.min("lon").alias("x0"), F.max("lon").alias("x1"),
                      F.max("area_name").alias("nm")))

    def pt(x, y):
        return F.format_string("[%.4f,%.4f]", F.col(x), F.col(y))

    geometry = F.concat(F.lit('{"type":"Polygon","coordinates":[['),
                        F.concat_ws(",", pt("x0", "y0"), pt("x1", "y0"), pt("x1", "y1"),
                                    pt("x0", "y1"), pt("x0", "y0")),
                        F.lit("]]}"))
    ks = k.cast("string")
    prec = (F.when(k.isNull(), _jstr("area_id"))
             .when(k == NULL_PREC_AREA, F.lit("null"))
             .when(k % 4 == 0, ks)
             .when(k % 4 == 1, F.concat(ks, F.lit(".0")))
             .when(k % 4 == 2, _jstr(_lpad(k, 2)))
             .otherwise(_jstr(ks)))
    no_label = F.coalesce(k == NO_LABEL_AREA, F.lit(False)) | F.col("nm").isNull()
    aprec = (F.when(no_label, F.lit(None))
              .when(k % 3 == 0, F.lit('""'))
              .when(k % 3 == 1, _jstr(F.concat(F.lit(" "), F.col("nm"), F.lit(" "))))
              .otherwise(F.lit(None)))
    name = F.when(no_label, F.lit(None)).otherwise(_jstr(F.concat(F.col("nm"), F.lit(" DIVISION"))))
    props = F.concat_ws(",", F.concat(F.lit('"prec":'), prec), F.concat(F.lit('"aprec":'), aprec),
                        F.concat(F.lit('"name":'), name),
                        F.concat(F.lit('"bureau":'), _jstr(F.concat(F.lit("BUREAU "), (k % 5).cast("string")))))
    feature = F.concat(F.lit('{"type":"Feature","geometry":'), geometry,
                       F.lit(',"properties":{'), props, F.lit("}}"))
    return boxes.select(F.concat(F.lit('{"type":"FeatureCollection","features":['), feature, F.lit("]}"))
                        .alias("value"))
