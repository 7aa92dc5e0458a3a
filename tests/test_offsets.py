"""Day offsets: the period's day component, against a pure-Python period model."""

import calendar
from datetime import date, timedelta

from pyspark.sql import functions as F

from stockcast.functions.dates import CALENDAR_DAYS, PERIOD_DAYS, day_offset


def _plus_months(d: date, n: int) -> date:
    m = d.year * 12 + d.month - 1 + n
    y, mo = divmod(m, 12)
    return date(y, mo + 1, min(d.day, calendar.monthrange(y, mo + 1)[1]))


def period_day_part(a: date, b: date) -> int:
    months = (b.year * 12 + b.month) - (a.year * 12 + a.month)
    days = b.day - a.day
    if months > 0 and days < 0:
        return (b - _plus_months(a, months - 1)).days
    if months < 0 and days > 0:
        return days - calendar.monthrange(b.year, b.month)[1]
    return days


def test_known_values():
    assert period_day_part(date(2021, 1, 1), date(2021, 2, 3)) == 2
    assert period_day_part(date(2021, 2, 1), date(2021, 1, 1)) == 0
    assert period_day_part(date(2021, 1, 31), date(2021, 3, 1)) == 1


def test_offsets_on_a_date_grid(spark):
    starts = [date(2020, 1, 1) + timedelta(days=i) for i in range(0, 800, 7)] + [
        date(2020, 2, 29), date(2021, 1, 31), date(2021, 3, 31), date(2020, 12, 31)
    ]
    pairs = [(a, a + timedelta(days=k)) for a in starts for k in range(-70, 120, 3)]
    df = spark.createDataFrame(pairs, "a date, b date")
    got = df.select(
        "a", "b",
        day_offset("a", "b", PERIOD_DAYS).alias("p"),
        day_offset("a", "b", CALENDAR_DAYS).alias("c"),
    ).collect()
    assert len(got) == len(pairs)
    for r in got:
        assert r["p"] == period_day_part(r["a"], r["b"]), (r["a"], r["b"])
        assert r["c"] == (r["b"] - r["a"]).days


def test_horizon_must_be_positive(spark):
    import pytest

    from stockcast.operators.projection import check_days

    with pytest.raises(ValueError):
        check_days(0)
