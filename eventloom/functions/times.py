"""Time arithmetic that does not depend on the session time zone."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000


def us(span: timedelta) -> int:
    """Microseconds of a duration, exact."""
    return (span.days * 86_400 + span.seconds) * 1_000_000 + span.microseconds


def micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of the wall-clock time."""
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    fraction = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    return F.unix_date(ts.cast("date")).cast("long") * DAY_US + seconds.cast("long") * 1_000_000 + fraction


def shift(ts: Column, micros_col: Column) -> Column:
    """Timestamp moved by a column of microseconds."""
    return F.timestamp_add("MICROSECOND", micros_col, ts)


def instant(t_us: Column) -> Column:
    """Wall-clock time of ``t_us`` microseconds, the inverse of ``micros``."""
    return F.timestamp_add("MICROSECOND", t_us, F.lit(datetime(1970, 1, 1)).cast("timestamp_ntz"))


def floor_time(ts: Column, width: timedelta) -> Column:
    """Largest multiple of ``width`` since the epoch that is not after ``ts``."""
    return shift(ts, -F.pmod(micros(ts), F.lit(us(width))))


def cell_start(t_us: Column, width: timedelta) -> Column:
    """Start of the time cell of ``width`` that holds ``t_us`` microseconds."""
    return t_us - F.pmod(t_us, F.lit(us(width)))


def date_parts(ts: Column, prefix: str = "") -> list[Column]:
    """Zero-padded year, month, day, hour and minute plus the two joined date texts."""
    formats = {
        "year": "yyyy",
        "month": "MM",
        "day": "dd",
        "hour": "HH",
        "minute": "mm",
        "year_month": "yyyy-MM",
        "year_month_day": "yyyy-MM-dd",
    }
    return [F.date_format(ts, pattern).alias(prefix + name) for name, pattern in formats.items()]


def fix_midnight_rollover(start: Column, peak: Column, end: Column) -> tuple[Column, Column]:
    """Move a peak before its start, then an end before that peak, to the next day."""
    one_day = timedelta(days=1)
    fixed_peak = F.when(start > peak, peak + F.lit(one_day)).otherwise(peak)
    fixed_end = F.when(fixed_peak > end, end + F.lit(one_day)).otherwise(end)
    return fixed_peak, fixed_end


def combine_date_and_time(start_text: Column, time_text: Column, fmt: str = "yyyy/MM/dd HH:mm:ss") -> Column:
    """Timestamp from the date of ``start_text`` and a clock time given alone."""
    date_text = F.split_part(F.trim(start_text), F.lit(" "), F.lit(1))
    return parse_time(F.concat_ws(" ", date_text, F.trim(time_text)), fmt)


def parse_time(text: Column, fmt: str) -> Column:
    """Text to a zone-free timestamp; NULL when it does not fit the format.

    The text is read as UTC and counted from the epoch, so clock changes of the session zone do not matter.
    """
    instant = F.try_to_timestamp(F.concat(text, F.lit("+00:00")), F.lit(fmt + "xxx"))
    return shift(F.lit("1970-01-01").cast("timestamp_ntz"), F.unix_micros(instant))


def rows_to_hours(rows: Column, cadence: timedelta = timedelta(minutes=12)) -> Column:
    """Hours covered by a number of rows of a regular series."""
    return rows / F.lit(timedelta(hours=1) / cadence)


def days_between(later: Column, earlier: Column) -> Column:
    """Signed difference in days as a double."""
    return (micros(later) - micros(earlier)) / F.lit(float(DAY_US))
