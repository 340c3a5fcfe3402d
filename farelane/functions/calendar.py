"""Calendar columns, week indexes, the holiday dimension and demand flags.

All of it is built from JVM-side column expressions; the holiday dimension is a
tiny DataFrame generated with ``sequence``/``explode`` from a year range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Hours counted as overnight and as evening rush.
OVERNIGHT_HOURS = [20, 21, 22, 23, 0, 1, 2, 3, 4, 5]
RUSH_HOURS = [16, 17, 18, 19]
# Spark dayofweek: 1 = Sunday, 7 = Saturday.
WEEKEND_DAYS = [1, 7]
# Base year and offset of the linear week index.
WEEK_BASE_YEAR = 2019
WEEK_OFFSET = 4


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def week_index_linear(ts) -> Column:
    """ISO week + (year - 2019) * 52 - 4 (mixes ISO week with calendar year)."""
    ts = _c(ts)
    return F.weekofyear(ts) + (F.year(ts) - WEEK_BASE_YEAR) * 52 - WEEK_OFFSET


def week_index_case(ts) -> Column:
    """Week index by year case: 2019 w, 2020 w+48, then +52 per year; later years +256."""
    ts = _c(ts)
    w, y = F.weekofyear(ts), F.year(ts)
    return (F.when(y == 2019, w)
            .when(y == 2020, w + 48)
            .when(y == 2021, w + 100)
            .when(y == 2022, w + 152)
            .when(y == 2023, w + 204)
            .otherwise(w + 256))


def week_start(ts) -> Column:
    """Monday of the week as a date: the clean weekly grain."""
    return F.to_date(F.date_trunc("week", _c(ts)))


def with_calendar(df: DataFrame, ts: str = "pickup_datetime",
                  prefix: str = "pickup") -> DataFrame:
    """Add date, year, month, day of year, hour, day of week and week index."""
    t = F.col(ts)
    return df.withColumns({
        f"{prefix}date": F.to_date(t),
        f"{prefix}year": F.year(t),
        f"{prefix}month": F.month(t),
        f"{prefix}dayofyear": F.dayofyear(t),
        f"{prefix}hour": F.hour(t),
        f"{prefix}dayofweek": F.dayofweek(t),
        "week": week_index_linear(t),
    })


def parse_date(c, fmt: str) -> Column:
    """Text to date; malformed text gives null instead of failing under ANSI."""
    return F.try_to_date(_c(c), fmt)


# --------------------------------------------------------------------------
# Holiday dimension
# --------------------------------------------------------------------------

def _nth_weekday(year: Column, month: int, weekday: str, n: int) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    return F.date_add(F.next_day(F.date_sub(first, 1), weekday), 7 * (n - 1))


def _last_weekday(year: Column, month: int, weekday: str) -> Column:
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    return F.next_day(F.date_sub(last, 7), weekday)


def _fixed(year: Column, month: int, day: int) -> Column:
    return F.make_date(year, F.lit(month), F.lit(day))


def _holiday_rules(y: Column, state_extras: bool) -> tuple[list, list]:
    """(name, date) of the year's holidays: on fixed dates, and on weekdays."""
    fixed = [
        ("New Year's Day", _fixed(y, 1, 1)),
        ("Juneteenth National Independence Day", F.when(y >= 2021, _fixed(y, 6, 19))),
        ("Independence Day", _fixed(y, 7, 4)),
        ("Veterans Day", _fixed(y, 11, 11)),
        ("Christmas Day", _fixed(y, 12, 25)),
    ]
    floating = [
        ("Martin Luther King Jr. Day", _nth_weekday(y, 1, "Mon", 3)),
        ("Washington's Birthday", _nth_weekday(y, 2, "Mon", 3)),
        ("Memorial Day", _last_weekday(y, 5, "Mon")),
        ("Labor Day", _nth_weekday(y, 9, "Mon", 1)),
        ("Columbus Day", _nth_weekday(y, 10, "Mon", 2)),
        ("Thanksgiving", _nth_weekday(y, 11, "Thu", 4)),
    ]
    if state_extras:
        fixed += [("Lincoln's Birthday", _fixed(y, 2, 12)),
                  ("Susan B. Anthony Day", _fixed(y, 2, 15))]
        floating += [("Election Day",
                      F.when(y % 2 == 0, F.date_add(_nth_weekday(y, 11, "Mon", 1), 1)))]
    return fixed, floating


def is_holiday(date, state_extras: bool = True) -> Column:
    """Whether a date is a holiday or its observed day, by the rules of its own year: no list, no join, any year.

    A fixed holiday is also observed on the Friday before a Saturday and the
    Monday after a Sunday; next year's New Year's Day may be observed on 31 December.
    """
    d = _c(date)
    y = F.year(d)
    fixed, floating = _holiday_rules(y, state_extras)
    days = [x for _, x in fixed] + [x for _, x in floating]
    dow = F.dayofweek(d)
    # the neighbour on which a fixed holiday would fall that is observed on this Friday or Monday
    neighbour = F.when(dow == 6, F.date_add(d, 1)).when(dow == 2, F.date_sub(d, 1))
    around, _ = _holiday_rules(F.year(neighbour), state_extras)
    hit = F.lit(False)
    for x in days:
        hit = hit | F.coalesce(d == x, F.lit(False))
    for _, x in around:
        hit = hit | F.coalesce(neighbour == x, F.lit(False))
    return hit


def holiday_dim(spark: SparkSession, first_year: int | None = None, end_year: int | None = None, state_extras: bool = True,
                years: DataFrame | None = None) -> DataFrame:
    """US federal (and New York) holidays as (holiday_date, holiday_name, is_observed).

    Rules (public calendar): 1 Jan; 3rd Mon Jan; 3rd Mon Feb; last Mon May;
    19 Jun from 2021; 4 Jul; 1st Mon Sep; 2nd Mon Oct; 11 Nov; 4th Thu Nov;
    25 Dec. New York extras: 12 Feb, 15 Feb, Election Day (Tuesday after the
    first Monday of November) in even years. A fixed-date holiday on a Saturday
    is also observed the Friday before, on a Sunday the Monday after.

    ``years`` is a one-column DataFrame of years (column ``year``), as
    ``holiday_dim_for`` derives from data, or else give ``[first_year, end_year)``.
    """
    if years is None:
        years = spark.range(first_year, end_year).select(F.col("id").cast("int").alias("year"))
    y = F.col("year")
    fixed, floating = _holiday_rules(y, state_extras)

    def entries(items, kind):
        return F.array(*[F.struct(F.lit(n).alias("holiday_name"), d.alias("holiday_date"),
                                  F.lit(kind).alias("kind")) for n, d in items])

    base = (years
            .select(y, F.inline(F.array_union(entries(fixed, "fixed"), entries(floating, "floating"))))
            .where(F.col("holiday_date").isNotNull()))
    dow = F.dayofweek("holiday_date")
    observed = (base.where(F.col("kind") == "fixed")
                .select(F.concat(F.col("holiday_name"), F.lit(" (observed)")).alias("holiday_name"),
                        F.when(dow == 7, F.date_sub("holiday_date", 1))
                        .when(dow == 1, F.date_add("holiday_date", 1)).alias("holiday_date"),
                        F.lit(True).alias("is_observed"))
                .where(F.col("holiday_date").isNotNull()))
    actual = base.select("holiday_name", "holiday_date", F.lit(False).alias("is_observed"))
    return actual.unionByName(observed).select("holiday_date", "holiday_name", "is_observed")


def holiday_dim_for(df: DataFrame, date_col: str, state_extras: bool = True) -> DataFrame:
    """Holiday dimension for every year spanned by ``df[date_col]``."""
    span = df.agg(F.min(F.year(date_col)).alias("y0"), F.max(F.year(date_col)).alias("y1"))
    years = span.select(F.explode(F.sequence("y0", "y1")).alias("year"))
    return holiday_dim(df.sparkSession, state_extras=state_extras, years=years)


def holiday_dates(holidays: DataFrame) -> DataFrame:
    """Distinct holiday dates, the join side of the weekend flag."""
    return holidays.select("holiday_date").distinct()


def with_demand_flags(df: DataFrame, date_col: str = "pickupdate",
                      hour_col: str = "pickuphour",
                      holidays: DataFrame | None = None) -> DataFrame:
    """Add isWeekend, isOvernight, isRushhour as 0/1 ints.

    isWeekend: holiday or Saturday/Sunday. isOvernight: hour in 20..23 or 0..5.
    isRushhour: hour in 16..19 **or** not isWeekend (every working-day trip).
    Holidays follow the rules of each date's own year; a ``holidays`` table of
    the caller's own replaces them and is joined by date, size-checked.
    """
    if holidays is None:
        marked, holiday = df, is_holiday(F.col(date_col))
    else:
        from ..session import join_small

        hd = holiday_dates(holidays).select(F.col("holiday_date").alias("_hdate"))
        marked = join_small(df, hd, F.col(date_col) == F.col("_hdate"), "left", max_rows=100_000)
        holiday = F.col("_hdate").isNotNull()
    off = F.coalesce(holiday | F.dayofweek(F.col(date_col)).isin(WEEKEND_DAYS), F.lit(False))
    hour = lambda hours: F.coalesce(F.col(hour_col).isin(hours), F.lit(False))
    flags = {"isWeekend": off, "isOvernight": hour(OVERNIGHT_HOURS), "isRushhour": hour(RUSH_HOURS) | ~off}
    return marked.withColumns({name: flag.cast("int") for name, flag in flags.items()}).drop("_hdate")
