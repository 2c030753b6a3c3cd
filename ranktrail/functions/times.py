"""Time columns: ages, the daily window and duration texts.

Intervals never appear as columns: ages are microseconds (long), thresholds are
seconds on the driver.
"""

import re
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

SECOND = 1_000_000
DAY = 86_400 * SECOND
#: Below this an age counted in months and days cannot differ from a plain difference.
PLAIN_AGE_LIMIT_SECONDS = 28 * 86_400


def moment(value, dtype: DataType) -> Column:
    """A run time as a literal of the table's own type.

    A naive datetime would otherwise be read in the driver's time zone.
    """
    if isinstance(value, datetime) and isinstance(dtype, TimestampNTZType):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(dtype)


def micros_between(new: Column, old: Column) -> Column:
    """new - old in microseconds."""
    return _micros(new) - _micros(old)


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def calendar_age_micros(new: Column, old: Column) -> Column:
    """Calendar age: whole months (of 30 days), days and time of day, in microseconds.

    A negative time of day borrows a day; a negative day borrows a month of the
    length of the older date's month. The age of an earlier ``new`` is the
    negated age the other way round.
    """
    late, early = F.greatest(new, old), F.least(new, old)
    time = _micros(late) % DAY - _micros(early) % DAY
    borrow_day = F.when(time < 0, 1).otherwise(0)
    days = F.dayofmonth(late) - F.dayofmonth(early) - borrow_day
    month_length = F.dayofmonth(F.last_day(early))
    months = (
        (F.year(late) - F.year(early)) * 12
        + (F.month(late) - F.month(early))
        - F.when(days < 0, 1).otherwise(0)
    )
    days = days + F.when(days < 0, month_length).otherwise(0)
    age = (months * 30 + days).cast("long") * DAY + time + borrow_day * DAY
    age = F.when(new < old, -age).otherwise(age)
    return F.when(new.isNotNull() & old.isNotNull(), age)


def is_older(new: Column, old: Column, seconds: float) -> Column:
    """Whether the calendar age of ``old`` at ``new`` has reached a threshold.

    Up to 28 days the plain difference decides the same way and is cheaper.
    """
    if seconds <= PLAIN_AGE_LIMIT_SECONDS:
        age = micros_between(new, old)
    else:
        age = calendar_age_micros(new, old)
    return age >= F.lit(int(seconds * SECOND))


def check_window(window: int) -> int:
    if not 0 <= window <= 86_399:
        raise ValueError(
            f"time window must be between 0 and 86399 seconds (one day), got {window}"
        )
    return window


def check_time_window(new: Column, old: Column, window: int) -> Column:
    """Whether ``new`` falls at most ``window`` seconds after the time of day of ``old``.

    One-sided, and wraps at midnight. 0 switches the test off. Where ``new`` is the
    earlier one the elapsed time of day is negative, hence inside any window.
    """
    if check_window(window) == 0:
        return F.lit(True)
    elapsed = F.pmod(micros_between(new, old), F.lit(DAY))
    inside = (elapsed < F.lit(window * SECOND)) | (new < old)
    return F.coalesce(inside, F.lit(False))


_UNITS = {
    "second": 1,
    "minute": 60,
    "hour": 3_600,
    "day": 86_400,
    "week": 7 * 86_400,
    "month": 30 * 86_400,
    "year": 360 * 86_400,
}
_PART = re.compile(r"([+-]?\d+(?:\.\d+)?)\s*([a-z]+?)s?(?:\s+|$)|(\d+):(\d\d)(?::(\d\d))?\s*$")


def duration_seconds(text: str) -> float:
    """Seconds in a duration text such as ``'19 minute'``; a month counts 30 days."""
    rest, total = text.strip().lower(), 0.0
    while rest:
        part = _PART.match(rest)
        if not part or (part[2] and part[2] not in _UNITS):
            raise ValueError(f"not a duration: {text!r}")
        if part[2]:
            total += float(part[1]) * _UNITS[part[2]]
        else:
            total += int(part[3]) * 3_600 + int(part[4]) * 60 + int(part[5] or 0)
        rest = rest[part.end() :]
    if not text.strip():
        raise ValueError("empty duration")
    return total
