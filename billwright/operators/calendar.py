"""Business calendar: holidays, first business days, and the window a report covers.

All of it is per day or per month of the dates given, so the tables here are as
small as the calendar itself.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Holidays on the same day every year, as (month, day, name, first year).
FIXED_HOLIDAYS = (
    (1, 1, "Confraternização Universal", 1900),
    (4, 21, "Tiradentes", 1900),
    (5, 1, "Dia do Trabalhador", 1900),
    (9, 7, "Independência do Brasil", 1900),
    (10, 12, "Nossa Senhora Aparecida", 1980),
    (11, 2, "Finados", 1900),
    (11, 15, "Proclamação da República", 1900),
    (11, 20, "Dia Nacional de Zumbi e da Consciência Negra", 2024),
    (12, 25, "Natal", 1900),
)
GOOD_FRIDAY = "Sexta-feira Santa"

# Holidays that go with Easter Sunday, as (days after it, name, first year).
MOVABLE_HOLIDAYS = ((-2, GOOD_FRIDAY, 1900),)

# Days on which many firms close although they are no holidays by law.
OPTIONAL_DAYS = (
    (-48, "Carnaval (segunda-feira)", 1900),
    (-47, "Carnaval", 1900),
    (-46, "Quarta-feira de Cinzas", 1900),
    (60, "Corpus Christi", 1900),
)

# What states add, as MOVABLE_HOLIDAYS. Espírito Santo: by state law of 2019.
STATE_HOLIDAYS = {"ES": ((8, "Nossa Senhora da Penha", 2020),)}

REGION = "BR"
STATE = "ES"

# "compat" skips weekends once and then holidays once, so that a holiday on a
# Friday yields the Saturday; "strict" wants a day that is neither.
COMPAT, STRICT = "compat", "strict"

_SATURDAY = 5

# Easter Sunday of the Gregorian calendar in whole numbers (Meeus, Jones, Butcher).
_EASTER_STEPS = {
    "golden": "year % 19",
    "century": "year div 100",
    "in_century": "year % 100",
    "correction": "(century - (century + 8) div 25 + 1) div 3",
    "epact": "(19 * golden + century - century div 4 - correction + 15) % 30",
    "weekday": "(32 + 2 * (century % 4) + 2 * (in_century div 4) - epact - in_century % 4) % 7",
    "late": "(golden + 11 * epact + 22 * weekday) div 451",
    "position": "epact + weekday - 7 * late + 114",
    "easter": "make_date(year, cast(position div 31 as int), cast(position % 31 + 1 as int))",
}


def month_of(day: Column) -> Column:
    return F.trunc(day, "MM")


def _one_row(spark: SparkSession) -> DataFrame:
    """A row to start from, in one partition: what grows from it is a calendar at most."""
    return spark.range(0, 1, 1, numPartitions=1)


def day_spine(dates: DataFrame, column: str, name: str = "as_of") -> DataFrame:
    """Every calendar day from the first to the last date of ``column``.

    The two dates are read at once, as the days are then used in several places.
    """
    span = dates.agg(F.min(column).alias("first"), F.max(column).alias("last")).first()
    days = F.sequence(F.lit(span["first"]).cast("date"), F.lit(span["last"]).cast("date"))
    return _one_row(dates.sparkSession).select(F.explode(days).alias(name))


def easter_sundays(years: DataFrame) -> DataFrame:
    """``years(year)`` -> ``(year, easter)``."""
    steps = years.select("year")
    for name, formula in _EASTER_STEPS.items():
        steps = steps.withColumn(name, F.expr(formula))
    return steps.select("year", "easter")


def holidays(years: DataFrame, state: str | None = STATE, optional: bool = False) -> DataFrame:
    """``years(year)`` -> ``(date, name, region)``: the holidays of these years.

    The nationwide ones, those of ``state`` (none if it is null) and, if asked for, the
    optional days. A holiday begins with the year that its law says. Any table of this
    form can take its place.
    """

    def days(named: tuple, date: Callable[..., Column]) -> Column:
        return F.array(*[
            F.struct(
                date(*when).alias("date"), F.lit(name).alias("name"), F.lit(region).alias("region"),
                F.lit(first).alias("first"),
            )
            for region, (*when, name, first) in named
        ])

    movable = [(REGION, day) for day in MOVABLE_HOLIDAYS + (OPTIONAL_DAYS if optional else ())]
    if state is not None:
        movable += [(f"{REGION}-{state}", day) for day in STATE_HOLIDAYS[state]]
    fixed = days(
        tuple((REGION, day) for day in FIXED_HOLIDAYS),
        lambda month, day: F.make_date("year", F.lit(month), F.lit(day)),
    )
    after_easter = days(tuple(movable), lambda after: F.date_add("easter", after))
    named = years.select("year", F.inline(fixed)).unionByName(
        easter_sundays(years).select("year", F.inline(after_easter))
    )
    return named.where(F.col("year") >= F.col("first")).select("date", "name", "region")


def holidays_around(
    days: DataFrame, day: str = "as_of", state: str | None = STATE, optional: bool = False
) -> DataFrame:
    """The holidays of the years that ``days`` touches."""
    return holidays(days.select(F.year(day).alias("year")).distinct(), state, optional)


def first_business_days(months: DataFrame, holiday_table: DataFrame, mode: str = COMPAT) -> DataFrame:
    """``months(month)`` -> ``(month, first_business_day)``.

    A month in which no day qualifies has no row.
    """
    weekday = F.weekday("month")
    to_monday = F.when(weekday >= _SATURDAY, 7 - weekday).otherwise(0)
    candidates = months.select(
        "month",
        F.explode(F.sequence(F.date_add("month", to_monday), F.last_day("month"))).alias("day"),
    )
    if mode == STRICT:
        candidates = candidates.where(F.weekday("day") < _SATURDAY)
    elif mode != COMPAT:
        raise ValueError(f"unknown calendar mode: {mode}")
    days_off = holiday_table.select(F.col("date").alias("day"))
    return (
        candidates.join(days_off, "day", "left_anti")
        .groupBy("month")
        .agg(F.min("day").alias("first_business_day"))
    )


def is_first_business_day(
    days: DataFrame, holiday_table: DataFrame, mode: str = COMPAT
) -> DataFrame:
    """``days(as_of)`` -> ``(as_of, is_first)``."""
    dated = days.select("as_of", month_of(F.col("as_of")).alias("month"))
    firsts = first_business_days(dated.select("month").distinct(), holiday_table, mode)
    is_first = F.col("as_of") == F.col("first_business_day")
    return dated.join(firsts, "month", "left").select(
        "as_of", F.coalesce(is_first, F.lit(False)).alias("is_first")
    )


def window_starts(days: DataFrame, holiday_table: DataFrame, mode: str = COMPAT) -> DataFrame:
    """``days(as_of)`` -> ``(as_of, is_first, window_start)``.

    On the first business day a report still covers the month before.
    """
    reported = F.when(F.col("is_first"), F.add_months("as_of", -1)).otherwise(F.col("as_of"))
    return is_first_business_day(days, holiday_table, mode).withColumn(
        "window_start", month_of(reported)
    )


def window_start_on(
    spark: SparkSession,
    as_of: datetime.date,
    holiday_table: DataFrame | None = None,
    mode: str = COMPAT,
) -> datetime.date:
    """Start of the window of one day's report, as a value to filter with."""
    day = _one_row(spark).select(F.lit(as_of).alias("as_of"))
    table = holidays_around(day) if holiday_table is None else holiday_table
    return window_starts(day, table, mode).first()["window_start"]
