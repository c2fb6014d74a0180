"""Pure ``Column`` builders. All JVM-side, all null-safe, none raises under ANSI.

Lenient parsing uses ``try_*`` functions: bad text becomes null instead of
failing the job (Spark 4 runs with ANSI mode on).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import codes


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- typing -----------------------------------------------------------------

def try_int(c: str | Column) -> Column:
    return col(c).try_cast("int")


def try_double(c: str | Column) -> Column:
    return col(c).try_cast("double")


def parse_ts(c: str | Column) -> Column:
    """ISO text (``yyyy-MM-ddTHH:mm:ss.SSS``) -> local wall-clock timestamp
    (TIMESTAMP_NTZ: no session-zone shift, no DST gaps); bad text -> null."""
    return col(c).try_cast("timestamp_ntz")


def hour_of_hhmm(hhmm_int: str | Column) -> Column:
    """``HHMM`` integer -> hour as bigint (``floor(x / 100)``)."""
    return F.floor(col(hhmm_int) / F.lit(100))


def minute_of_hhmm(hhmm_int: str | Column) -> Column:
    return col(hhmm_int) % F.lit(100)


# --- cleaning ---------------------------------------------------------------

def norm_text(c: str | Column) -> Column:
    """Trim spaces at both ends, then collapse every whitespace run to one space.

    ``trim`` removes only spaces, so a leading tab survives the trim and is then
    turned into a single space (``"\\t a"`` -> ``" a"``).
    """
    x = F.trim(col(c))
    # most text holds single spaces only: look for anything else before using the pattern
    runs = [F.contains(x, F.lit(w)) for w in ("  ", "\t", "\n", "\x0b", "\f", "\r")]
    return F.when(reduce(lambda a, b: a | b, runs), F.regexp_replace(x, r"\s+", " ")).otherwise(x)


def default_if_null(c: str | Column, default: str) -> Column:
    return F.coalesce(col(c), F.lit(default))


def blank_to_unknown(c: str | Column) -> Column:
    """``COALESCE(NULLIF(TRIM(x), ''), 'Unknown')``."""
    return F.coalesce(F.nullif(F.trim(col(c)), F.lit("")), F.lit(codes.UNKNOWN))


def null_outside(c: str | Column, lo, hi) -> Column:
    """Value kept when ``lo <= c <= hi`` (a null bound means open), else null."""
    x = col(c)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (x < F.lit(lo))
    if hi is not None:
        bad = bad | (x > F.lit(hi))
    return F.when(bad, F.lit(None)).otherwise(x)


def victim_age_raw(c: str | Column) -> Column:
    """Age text -> int kept only when ``0 < age < 120``."""
    a = try_int(c)
    return F.when((a > 0) & (a < 120), a)


def victim_sex(c: str | Column) -> Column:
    x = col(c)
    return F.when(x.isin(*codes.VICTIM_SEX_VALUES), x).otherwise(F.lit(codes.UNKNOWN))


def crime_category(part_code: str | Column) -> Column:
    """Part code text ``"1"`` -> Violent, ``"2"`` -> Non-Violent, anything else -> Other."""
    p = col(part_code)
    return (F.when(p == F.lit("1"), F.lit(codes.VIOLENT))
             .when(p == F.lit("2"), F.lit(codes.NON_VIOLENT))
             .otherwise(F.lit(codes.OTHER)))


def geo_valid(lat: str | Column = "lat", lon: str | Column = "lon") -> Column:
    """Both coordinates present and not the (0, 0) placeholder."""
    la, lo = col(lat), col(lon)
    return la.isNotNull() & lo.isNotNull() & ~((la == 0) & (lo == 0))


def invalid_time(hour: str | Column = "hour_occ", minute: str | Column = "minute_occ") -> Column:
    """Hour outside 0-23 or minute outside 0-59 (three-valued: null unless one arm is true)."""
    return ~col(hour).between(0, 23) | ~col(minute).between(0, 59)


# --- calendar ---------------------------------------------------------------

def weekday_short(c: str | Column) -> Column:
    """``Mon`` ... ``Sun``."""
    return F.date_format(col(c), "E")


def weekday_index(c: str | Column) -> Column:
    """0 = Monday ... 6 = Sunday, for ordering weekday labels."""
    return F.weekday(col(c))


def weekday_order(name: str | Column) -> Column:
    """Position of a short or full weekday name, Monday = 1 (0 when unknown)."""
    n = col(name)
    return F.greatest(F.array_position(F.array(*[F.lit(d) for d in codes.WEEKDAYS_SHORT]), n),
                      F.array_position(F.array(*[F.lit(d) for d in codes.WEEKDAYS_FULL]), n))


def occurrence_ts(date_occ: str | Column = "date_occ", hour: str | Column = "hour_occ",
                  minute: str | Column = "minute_occ") -> Column:
    """Local wall-clock timestamp (TIMESTAMP_NTZ) from the occurrence day plus
    ``hour:minute``.

    Any null part, hour outside 0-23 or minute outside 0-59 gives null. (Joining
    text with ``concat_ws`` would silently drop a null date and parse the time
    alone as *today*; the guard avoids that.) Without a zone, a time inside a
    daylight-saving gap (e.g. 02:30 on the spring-forward day) is kept as recorded
    whatever the session time zone.
    """
    d = F.to_date(col(date_occ))
    h, m = col(hour), col(minute)
    ok = d.isNotNull() & h.between(0, 23) & m.between(0, 59)
    return F.when(ok, F.try_make_timestamp_ntz(
        F.year(d), F.month(d), F.dayofmonth(d), h.cast("int"), m.cast("int"), F.lit(0)))


def month_start(c: str | Column) -> Column:
    """First day of the month as a DATE."""
    return F.trunc(F.to_date(col(c)), "month")


# --- derived features -------------------------------------------------------

def has_weapon(weapon: str | Column) -> Column:
    return ~F.lower(col(weapon)).isin(*codes.NO_WEAPON_LABELS)


def hour_bucket(hour: str | Column = "hour_occ") -> Column:
    h = col(hour)
    return (F.when(h.between(0, 5), F.lit("Night"))
             .when(h.between(6, 11), F.lit("Morning"))
             .when(h.between(12, 17), F.lit("Afternoon"))
             .otherwise(F.lit("Evening")))


def victim_age_group(age: str | Column = "victim_age") -> Column:
    a = col(age)
    return (F.when(a.isNull(), F.lit(codes.UNKNOWN))
             .when(a <= 17, F.lit("Child"))
             .when(a <= 25, F.lit("YoungAdult"))
             .when(a <= 64, F.lit("Adult"))
             .otherwise(F.lit("Senior")))


def is_night(hour: str | Column = "hour_occ") -> Column:
    lo, hi = codes.NIGHT_HOURS
    return col(hour).between(lo, hi)


def macro_category(crime_code: str | Column = "crime_code") -> Column:
    """Crime code -> macro category; first list that contains the code wins.

    ``isin`` over literal lists becomes a hashed ``InSet`` test in codegen, so this
    stays a single projection (no join, no UDF).
    """
    code = try_int(crime_code)
    expr = None
    for label, values in codes.MACRO_CATEGORIES:
        cond = code.isin(*values)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(codes.MACRO_OTHER))


def share(part: str | Column, total: str | Column) -> Column:
    """``part / total`` as double, 0 when the total is 0 or null."""
    t = col(total)
    return F.when(F.coalesce(t, F.lit(0)) == 0, F.lit(0.0)).otherwise(
        col(part).cast("double") / t)


def label(c: str | Column, n: int = codes.LABEL_CHARS) -> Column:
    """First ``n`` characters of a label."""
    return F.substring(col(c), 1, n)


# --- area keys --------------------------------------------------------------

# ASCII characters that Python's str.strip() removes.
PY_WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"
_DIGITS = r"\d(?:_?\d)*"
# A decimal literal as Python's float() reads it (underscores only between digits);
# Java-only forms such as a trailing d/f or hex are not numbers here.
NUMERIC_TEXT = (rf"^\s*[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})"
                rf"(?:[eE][+-]?{_DIGITS})?\s*$")


def strip_ws(c: str | Column) -> Column:
    """Strip ASCII whitespace at both ends (``str.strip()`` on ASCII text)."""
    return F.btrim(col(c), F.lit(PY_WHITESPACE))


def area_key(c: str | Column) -> Column:
    """Area id normaliser: null -> ``""``; numeric text -> integer text, truncated
    (``"01"``, ``"1.0"``, ``"1.9"`` -> ``"1"``); other text -> stripped text.
    Integers beyond the bigint range stay text."""
    x = col(c).cast("string")
    as_int = F.when(x.rlike(NUMERIC_TEXT),
                    F.replace(x, F.lit("_"), F.lit("")).try_cast("double")
                     .try_cast("bigint").cast("string"))
    return F.coalesce(as_int, strip_ws(x), F.lit(""))


def first_label(*cols: str | Column) -> Column:
    """First non-empty of the given texts (else ``""``), stripped."""
    parts = [F.nullif(col(c), F.lit("")) for c in cols]
    return strip_ws(F.coalesce(*parts, F.lit("")))
