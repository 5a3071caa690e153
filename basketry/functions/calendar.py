"""Calendar columns and holiday tables.

Holiday tables are generated with ``sequence`` + filters on the executors
from rules (nth weekday, observed shift) — no per-row Python."""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def calendar_columns(d) -> dict[str, Column]:
    """Day of week (Monday = 0), weekend, month, quarter, year, day,
    day of year, ISO week, month start / end flags."""
    c = F.col(d) if isinstance(d, str) else d
    return {
        "dayofweek": F.weekday(c), "is_weekend": (F.weekday(c) >= 5).cast("int"), "month": F.month(c),
        "quarter": F.quarter(c), "year": F.year(c), "dayofmonth": F.dayofmonth(c), "dayofyear": F.dayofyear(c),
        "weekofyear": F.weekofyear(c), "is_month_start": (F.dayofmonth(c) == 1).cast("int"),
        "is_month_end": (c == F.last_day(c)).cast("int"),
    }


def calendar_table(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumns(calendar_columns(date_col))


def cyclic_encoding(x, period: int, name: str, offset: int = 0) -> dict[str, Column]:
    """sin/cos of 2π(x − offset)/period."""
    c = (F.col(x) if isinstance(x, str) else x) - F.lit(offset)
    ang = F.lit(2 * math.pi) * c / F.lit(float(period))
    return {f"{name}_sin": F.sin(ang), f"{name}_cos": F.cos(ang)}


def days_to_year_end(d) -> Column:
    """Days until 31 December of the same year."""
    c = F.col(d) if isinstance(d, str) else d
    return F.datediff(F.make_date(F.year(c), F.lit(12), F.lit(31)), c)


# Vietnamese public holidays — fixed-date days (month, day),
# first day of Tet per year (holiday runs from 2 days before to 4 days after)
# and the Hung Kings commemoration day per year.
VN_FIXED_DAYS = [(1, 1), (4, 30), (5, 1), (9, 2)]
VN_TET_FIRST_DAY = {
    2012: "2012-01-23", 2013: "2013-02-10", 2014: "2014-01-31", 2015: "2015-02-19", 2016: "2016-02-08",
    2017: "2017-01-28", 2018: "2018-02-16", 2019: "2019-02-05", 2020: "2020-01-25", 2021: "2021-02-12",
    2022: "2022-02-01", 2023: "2023-01-22", 2024: "2024-02-10", 2025: "2025-01-29", 2026: "2026-02-17",
}
VN_HUNG_KINGS = {
    2012: "2012-03-31", 2013: "2013-04-19", 2014: "2014-04-09", 2015: "2015-04-28", 2016: "2016-04-16",
    2017: "2017-04-06", 2018: "2018-04-25", 2019: "2019-04-14", 2020: "2020-04-02", 2021: "2021-04-21",
    2022: "2022-04-10", 2023: "2023-04-29", 2024: "2024-04-18", 2025: "2025-04-07", 2026: "2026-04-26",
}
TET_WINDOW = (-2, 4)


def _new_moon(k: int) -> int:
    """Julian day (UTC+7) of the k-th new moon since 1900, mean motion plus the
    periodic terms of sun and moon."""
    t = k / 1236.85
    sin = lambda deg: math.sin(math.radians(deg))
    day = 2415020.75933 + 29.53058868 * k + (0.0001178 - 0.000000155 * t) * t * t + 0.00033 * sin(166.56 + (132.87 - 0.009173 * t) * t)
    sun = 359.2242 + 29.10535608 * k - (0.0000333 + 0.00000347 * t) * t * t
    moon = 306.0253 + 385.81691806 * k + (0.0107306 + 0.00001236 * t) * t * t
    node = 21.2964 + 390.67050646 * k - (0.0016528 + 0.00000239 * t) * t * t
    terms = [(0.1734 - 0.000393 * t, sun), (0.0021, 2 * sun), (-0.4068, moon), (0.0161, 2 * moon), (-0.0004, 3 * moon),
             (0.0104, 2 * node), (-0.0051, sun + moon), (-0.0074, sun - moon), (0.0004, 2 * node + sun),
             (-0.0004, 2 * node - sun), (-0.0006, 2 * node + moon), (0.0010, 2 * node - moon), (0.0005, 2 * moon + sun)]
    clock = -0.000278 + (0.000265 + 0.000262 * t) * t
    return math.floor(day + sum(a * sin(x) for a, x in terms) - clock + 0.5 + 7 / 24)


def _sun_sector(day: int) -> int:
    """Twelfth of the zodiac (0 from the spring equinox) at local midnight."""
    t = (day - 2451545.5 - 7 / 24) / 36525
    m = math.radians(357.52910 + (35999.05030 - (0.0001559 + 0.00000048 * t) * t) * t)
    centre = (1.914600 - (0.004817 + 0.000014 * t) * t) * math.sin(m) + (0.019993 - 0.000101 * t) * math.sin(2 * m) + 0.000290 * math.sin(3 * m)
    return int((280.46645 + (36000.76983 + 0.0003032 * t) * t + centre) % 360 // 30)


def lunar_date(year: int, month: int, day: int) -> str:
    """Gregorian date of a day of the lunisolar year that begins in ``year``
    (months 1-10; no leap month): months start at new moons, month 11 holds the
    winter solstice, and the first month without a change of sun sector is a
    leap month."""
    def eleventh(y):
        k = int((date(y, 12, 31).toordinal() + 1721425 - 2415021) / 29.530588853)
        return k if _sun_sector(_new_moon(k)) < 9 else k - 1

    a, b = eleventh(year - 1), eleventh(year)
    index = month + 1  # months after the eleventh
    if _new_moon(b) - _new_moon(a) > 365:
        sectors = [_sun_sector(_new_moon(a + i)) for i in range(15)]
        leap = next(i for i in range(1, 14) if sectors[i] == sectors[i + 1])
        index += index >= leap
    return date.fromordinal(_new_moon(a + index) - 1721425 + day - 1).isoformat()


def fixed_holiday_table(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """One row per holiday date for the years (fixed days, Tet window,
    Hung Kings day); a small dimension table. Years outside the fixed tables
    get their moving days from the lunisolar calendar."""
    rows = []
    for y in range(first_year, last_year + 1):
        rows += [(f"{y}-{m:02d}-{d:02d}", "fixed") for m, d in VN_FIXED_DAYS]
        rows.append((VN_TET_FIRST_DAY.get(y) or lunar_date(y, 1, 1), "tet"))
        rows.append((VN_HUNG_KINGS.get(y) or lunar_date(y, 3, 10), "hung_kings"))
    base = spark.createDataFrame(rows, "day string, kind string").select(F.to_date("day").alias("day"), "kind")
    tet = base.filter(F.col("kind") == "tet").select(
        F.explode(F.sequence(F.date_add("day", TET_WINDOW[0]), F.date_add("day", TET_WINDOW[1]))).alias("holiday_date"))
    other = base.filter(F.col("kind") != "tet").select(F.col("day").alias("holiday_date"))
    return tet.unionByName(other).distinct()


def _nth_weekday(year: Column, month: int, weekday: int, n: int) -> Column:
    """n-th (1-based; n = -1 → last) given weekday (Mon = 0) of a month."""
    first = F.make_date(year, F.lit(month), F.lit(1))
    if n > 0:
        shift = (F.lit(weekday) - F.weekday(first) + 7) % 7
        return F.date_add(first, (shift + (n - 1) * 7).cast("int"))
    last = F.last_day(first)
    back = (F.weekday(last) - F.lit(weekday) + 7) % 7
    return F.date_sub(last, back.cast("int"))


def _observed(d: Column) -> Column:
    """Nearest workday: Saturday → Friday, Sunday → Monday."""
    wd = F.weekday(d)
    return F.when(wd == 5, F.date_sub(d, 1)).when(wd == 6, F.date_add(d, 1)).otherwise(d)


# US federal holiday rules (name, month, rule, first year).
# rule: ("fixed", day) observed on the nearest workday, or ("nth", weekday, n).
US_FEDERAL_RULES = [
    ("new_years_day", 1, ("fixed", 1), None), ("mlk_day", 1, ("nth", 0, 3), 1986),
    ("presidents_day", 2, ("nth", 0, 3), None), ("memorial_day", 5, ("nth", 0, -1), None),
    ("juneteenth", 6, ("fixed", 19), 2021), ("independence_day", 7, ("fixed", 4), None),
    ("labor_day", 9, ("nth", 0, 1), None), ("columbus_day", 10, ("nth", 0, 2), None),
    ("veterans_day", 11, ("fixed", 11), None), ("thanksgiving", 11, ("nth", 3, 4), None),
    ("christmas", 12, ("fixed", 25), None),
]


def us_federal_holidays(spark: SparkSession, start: str, end: str) -> DataFrame:
    """US federal holidays (observed dates) between two dates, built
    from the rule table over a ``sequence`` of years."""
    years = spark.range(1).select(F.explode(F.sequence(F.year(F.to_date(F.lit(start))) - 1,
                                                       F.year(F.to_date(F.lit(end))) + 1)).alias("y"))
    parts = []
    for name, month, rule, since in US_FEDERAL_RULES:
        y = F.col("y")
        if rule[0] == "fixed":
            d = _observed(F.make_date(y, F.lit(month), F.lit(rule[1])))
        else:
            d = _nth_weekday(y, month, rule[1], rule[2])
        sel = years.select(F.lit(name).alias("holiday"), d.alias("holiday_date"), y)
        if since:
            sel = sel.filter(F.col("y") >= since)
        parts.append(sel)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter(F.col("holiday_date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).drop("y")


def holiday_flag(df: DataFrame, date_col: str, holidays: DataFrame, out: str = "is_holiday",
                 window_days: int = 0) -> DataFrame:
    """Left join to a holiday dimension (± ``window_days``) → 0/1 flag."""
    h = holidays.select("holiday_date")
    if window_days:
        h = h.select(F.explode(F.sequence(F.date_sub("holiday_date", window_days),
                                          F.date_add("holiday_date", window_days))).alias("holiday_date"))
    h = h.distinct().select(F.col("holiday_date").alias(date_col), F.lit(1).alias(out))
    return df.join(h, date_col, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0)))
