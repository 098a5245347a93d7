"""Dates and times.  All wall-clock: nothing here reads the session time zone.

``date_trunc`` and ``unix_micros`` go through a zoned timestamp and shift times
that fall into a daylight-saving gap, so they are avoided.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def calendar_year(c: Column | str) -> Column:
    """Calendar year.  Beside ``iso_week`` it puts 2024-12-30 into (2024, 1)."""
    return F.year(_col(c)).cast("long")


def iso_year(c: Column | str) -> Column:
    """Year the ISO week belongs to."""
    return F.extract(F.lit("YEAROFWEEK"), _col(c)).cast("long")


def iso_week(c: Column | str) -> Column:
    return F.weekofyear(_col(c)).cast("long")


def month_of(c: Column | str) -> Column:
    return F.month(_col(c)).cast("long")


def period_columns(c: Column | str, period: str, year_mode: str = "calendar") -> list[Column]:
    """``[year, week]`` or ``[year, month]`` of a date or time."""
    year = iso_year(c) if (year_mode == "iso" and period == "week") else calendar_year(c)
    part = {"week": iso_week, "month": month_of}[period](c)
    return [year.alias("year"), part.alias(period)]


def whole_periods(first: date, last: date, period: str) -> list[date]:
    """All days of the periods that the days from ``first`` to ``last`` are in.

    Years are calendar years: week 1 of a year also holds the last days of its
    December, and they are in the list with those of its January.
    """
    of = lambda d: (d.year, d.isocalendar().week if period == "week" else d.month)
    days = lambda a, b: [a + timedelta(n) for n in range((b - a).days + 1)]
    touched = {of(d) for d in days(first, last)}
    return [d for d in days(date(first.year, 1, 1), date(last.year, 12, 31)) if of(d) in touched]


def epoch_second(c: Column | str) -> Column:
    """Whole seconds since 1970-01-01, rounded down, also before 1970."""
    c = _col(c)
    days = F.date_diff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
    return (
        days * DAY_SECONDS
        + F.hour(c) * 3600
        + F.minute(c) * 60
        + F.second(c)
    )


def round_to_second(c: Column | str) -> Column:
    """Nearest second.  A tie moves away from 2000-01-01 00:00:00."""
    c = _col(c)
    fraction = F.extract(F.lit("SECOND"), c) % 1
    before = c < F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    up = F.when(before, fraction > 0.5).otherwise(fraction >= 0.5)
    floor = c - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), fraction)
    return F.when(up, floor + F.expr("INTERVAL 1 SECOND")).otherwise(floor)


def plus_seconds(c: Column | str, seconds: int) -> Column:
    return _col(c) + F.expr(f"INTERVAL {int(seconds)} SECONDS")


def till_timestamp(c: Column | str) -> Column:
    """``13.10.2025 14:21:58`` to a time; anything else is null."""
    c = _col(c)
    shape = r"^(\d{1,2})\.(\d{1,2})\.(\d{4}) (\d{1,2}:\d{1,2}:\d{1,2})$"
    return F.when(c.rlike(shape), F.regexp_replace(c, shape, "$3-$2-$1 $4")).try_cast("timestamp_ntz")


def day_first_timestamp(c: Column | str) -> Column:
    """Lenient reading, day before month where both are possible; ISO stays ISO.

    ``05.11.2025 10:00``, ``5/11/2025`` and ``2025-11-05 10:00:00`` are all
    5 November.  A second part over 12 can only be the day, so it is swapped.
    """
    c = F.regexp_replace(_col(c), r"^\s+|\s+$", "")
    clock = r"(?:[ T]+(\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,6})?)?))?$"
    day_first = r"^(\d{1,2})[./-](\d{1,2})[./-](\d{4})" + clock
    iso = r"^(\d{4})[./-](\d{1,2})[./-](\d{1,2})" + clock
    second_part = F.regexp_extract(c, day_first, 2).try_cast("int")
    text = (
        F.when(c.rlike(iso), F.regexp_replace(c, iso, "$1-$2-$3 $4"))
        .when(c.rlike(day_first) & (second_part > 12), F.regexp_replace(c, day_first, "$3-$1-$2 $4"))
        .when(c.rlike(day_first), F.regexp_replace(c, day_first, "$3-$2-$1 $4"))
    )
    return F.trim(text).try_cast("timestamp_ntz")


def order_timestamp(c: Column | str) -> Column:
    """``2025-10-13T14:21:58`` with an optional ``+hhmm``; the wall time is kept.

    A negative offset, a ``Z`` or any other text is null.
    """
    c = _col(c)
    offset = r"\+(?:[01]\d|2[0-3]):?[0-5]\d(?::?[0-5]\d)?"
    shape = r"^(\d{4}-\d{1,2}-\d{1,2})T(\d{1,2}:\d{1,2}:\d{1,2})(?:" + offset + ")?$"
    return F.when(c.rlike(shape), F.regexp_replace(c, shape, "$1 $2")).try_cast("timestamp_ntz")


def month_start_text(c: Column | str) -> Column:
    """``15.10.2025`` to ``2025-10-01``; text without dots is kept; else null."""
    c = _col(c)
    parts = F.split(c, r"\.")
    return F.when(~c.contains("."), c).when(
        F.size(parts) == 3, F.concat(parts[2], F.lit("-"), parts[1], F.lit("-01"))
    )


def loose_date(c: Column | str) -> Column:
    """Sheet date text, ISO or day first, to a date; null when it is neither."""
    return F.to_date(day_first_timestamp(c))


def time_text(c: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` with a fraction only where there is one."""
    return _col(c).cast("string")
