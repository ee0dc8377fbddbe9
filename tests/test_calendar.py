"""Holidays, first business days and report windows."""

import datetime

import pytest
from pyspark.sql import functions as F

from billwright.operators import calendar as C

D = datetime.date


@pytest.fixture(scope="module")
def years(spark):
    return spark.range(1995, 2036).select(F.col("id").cast("int").alias("year"))


@pytest.fixture(scope="module")
def firsts(spark, years):
    months = years.select(
        F.explode(F.sequence(F.make_date("year", F.lit(1), F.lit(1)),
                             F.make_date("year", F.lit(12), F.lit(1)),
                             F.expr("interval 1 month"))).alias("month")
    )
    table = C.holidays(years)
    return {
        mode: {r["month"]: r["first_business_day"]
               for r in C.first_business_days(months, table, mode).collect()}
        for mode in (C.COMPAT, C.STRICT)
    }


def test_easter(years):
    easter = {r["year"]: r["easter"] for r in C.easter_sundays(years).collect()}
    assert easter[2000] == D(2000, 4, 23)
    assert easter[2008] == D(2008, 3, 23)
    assert easter[2011] == D(2011, 4, 24)
    assert easter[2026] == D(2026, 4, 5)


def test_good_friday(years):
    rows = C.holidays(years).where(F.col("name") == C.GOOD_FRIDAY).collect()
    assert D(2026, 4, 3) in [r["date"] for r in rows]
    nationwide = C.holidays(years, state=None)
    assert nationwide.count() == 9 * 41 + 12  # 20 November since 2024
    assert C.holidays(years).count() == nationwide.count() + 16
    assert C.holidays(years, None, optional=True).count() == nationwide.count() + 4 * 41


def test_days_of_one_year(spark):
    year = spark.createDataFrame([(2024,)], "year int")
    named = {(r["date"], r["region"]) for r in C.holidays(year, optional=True).collect()}
    assert {(D(2024, 11, 20), "BR"), (D(2024, 4, 8), "BR-ES"), (D(2024, 2, 13), "BR"), (D(2024, 5, 30), "BR")} <= named
    earlier = spark.createDataFrame([(2019,)], "year int")
    assert {r["date"] for r in C.holidays(earlier).collect()}.isdisjoint({D(2019, 11, 20), D(2019, 4, 29)})


def test_carnival_can_be_the_first_of_a_month(spark):
    """1 March 2022 was Carnival Tuesday."""
    month = spark.createDataFrame([(D(2022, 3, 1),)], "month date")
    year = spark.createDataFrame([(2022,)], "year int")
    first = lambda optional: C.first_business_days(month, C.holidays(year, optional=optional)).first()[1]
    assert first(False) == D(2022, 3, 1) and first(True) == D(2022, 3, 3)


def test_matches_a_day_by_day_walk(years, firsts):
    days_off = {r["date"] for r in C.holidays(years).collect()}
    one = datetime.timedelta(days=1)
    for month in firsts[C.COMPAT]:
        day = month
        while day.weekday() > 4:
            day += one
        while day in days_off:
            day += one
        assert firsts[C.COMPAT][month] == day
        day = month
        while day.weekday() > 4 or day in days_off:
            day += one
        assert firsts[C.STRICT][month] == day
    assert len(firsts[C.COMPAT]) == len(firsts[C.STRICT]) == 492


def test_months_in_which_the_modes_differ(firsts):
    differ = sorted(m for m in firsts[C.COMPAT] if firsts[C.COMPAT][m] != firsts[C.STRICT][m])
    assert differ == [
        D(1998, 5, 1), D(1999, 1, 1), D(2009, 5, 1), D(2010, 1, 1), D(2015, 5, 1),
        D(2016, 1, 1), D(2020, 5, 1), D(2021, 1, 1), D(2026, 5, 1), D(2027, 1, 1),
    ]
    assert firsts[C.COMPAT][D(2026, 5, 1)] == D(2026, 5, 2)
    assert firsts[C.STRICT][D(2026, 5, 1)] == D(2026, 5, 4)


@pytest.mark.parametrize(
    ("as_of", "compat", "strict"),
    [
        (D(2026, 5, 1), D(2026, 5, 1), D(2026, 5, 1)),
        (D(2026, 5, 2), D(2026, 4, 1), D(2026, 5, 1)),
        (D(2026, 5, 4), D(2026, 5, 1), D(2026, 4, 1)),
        (D(2001, 8, 1), D(2001, 7, 1), D(2001, 7, 1)),
        (D(2024, 1, 2), D(2023, 12, 1), D(2023, 12, 1)),
    ],
)
def test_window_start(spark, as_of, compat, strict):
    assert C.window_start_on(spark, as_of) == compat
    assert C.window_start_on(spark, as_of, mode=C.STRICT) == strict


def test_own_holidays(spark):
    table = spark.createDataFrame([(D(2026, 6, 1), "local", "ES")], "date date, name string, region string")
    assert C.window_start_on(spark, D(2026, 6, 1), table) == D(2026, 6, 1)
    assert C.window_start_on(spark, D(2026, 6, 2), table) == D(2026, 5, 1)


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        C.window_start_on(spark, D(2026, 6, 1), mode="other")
