"""Date expressions: instant → local date, day offsets, readable date-times.

All are built-in Column expressions (codegen'd, no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIOD_DAYS = "period_days"
CALENDAR_DAYS = "calendar_days"
OFFSET_MODES = (PERIOD_DAYS, CALENDAR_DAYS)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instant_to_date(ts) -> Column:
    """Local date of an instant, in the session time zone."""
    return F.to_date(_col(ts))


def period_days(a, b) -> Column:
    """Day component of the calendar period from date ``a`` to date ``b``.

    This is the *days* part of a years/months/days period, not the total
    number of days: 2021-01-01 → 2021-02-03 gives 2, 2021-02-01 → 2021-01-01
    gives 0. A month is taken off when the day of ``b`` is before the day of
    ``a``; when ``b`` is in an earlier month with a later day, the length of
    ``b``'s month is taken off the day difference.
    """
    a, b = _col(a), _col(b)
    months = (F.year(b) * 12 + F.month(b)) - (F.year(a) * 12 + F.month(a))
    days = F.dayofmonth(b) - F.dayofmonth(a)
    return (
        F.when((months > 0) & (days < 0), F.datediff(b, F.add_months(a, months - 1)))
        .when((months < 0) & (days > 0), days - F.dayofmonth(F.last_day(b)))
        .otherwise(days)
    )


def day_offset(stock_date, deliver_date, mode: str = PERIOD_DAYS) -> Column:
    """Offset (in days) of a delivery date from the stock date.

    ``period_days`` (default) reproduces the reference exactly; ``calendar_days``
    is the plain number of days between the two dates.
    """
    if mode == PERIOD_DAYS:
        return period_days(stock_date, deliver_date)
    if mode == CALENDAR_DAYS:
        return F.datediff(_col(deliver_date), _col(stock_date))
    raise ValueError(f"unknown offset mode {mode!r}; expected one of {OFFSET_MODES}")


def readable_time(ts) -> Column:
    """Local date-time as ISO text, seconds dropped when zero (``2021-01-02T10:00``),
    milliseconds shown when not zero."""
    ts = _col(ts)
    millis = F.unix_millis(ts) % 1000
    return (
        F.when(millis != 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .when(F.second(ts) == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
    )
