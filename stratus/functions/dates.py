"""Calendar and clock expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date_lit(d) -> Column:
    """A date literal from ``date``/ISO string."""
    if isinstance(d, Column):
        return d
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.isoformat()[:10]
    return F.to_date(F.lit(d))


def date_id(d: ColumnOrName) -> Column:
    """YYYYMMDD integer key of a date or timestamp (arithmetic, no string formatting)."""
    d = F.to_date(_c(d))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_from_id(i: ColumnOrName) -> Column:
    """Inverse of :func:`date_id`."""
    i = _c(i)
    return F.make_date(F.floor(i / 10000).cast("int"), (F.floor(i / 100) % 100).cast("int"), (i % 100).cast("int"))


def time_id(ts: ColumnOrName) -> Column:
    """HHMM integer key of a timestamp."""
    ts = _c(ts)
    return (F.hour(ts) * 100 + F.minute(ts)).cast("int")


def iso_week(d: ColumnOrName) -> Column:
    return F.weekofyear(_c(d)).cast("smallint")


def iso_dow(d: ColumnOrName) -> Column:
    """ISO day of week, 1 = Monday … 7 = Sunday."""
    return (F.weekday(_c(d)) + 1).cast("smallint")


def month_name(d: ColumnOrName, padded: bool = False) -> Column:
    """English month name (``January``); ``padded=True`` blank-pads to 9 characters as
    PostgreSQL's ``TO_CHAR(d, 'Month')`` does."""
    n = F.date_format(_c(d), "MMMM")
    return F.rpad(n, 9, " ") if padded else n


def day_name(d: ColumnOrName, padded: bool = False) -> Column:
    """English day name (``Monday``); ``padded=True`` blank-pads to 9 characters."""
    n = F.date_format(_c(d), "EEEE")
    return F.rpad(n, 9, " ") if padded else n


def is_weekend(d: ColumnOrName) -> Column:
    return iso_dow(d).isin(6, 7)


def is_leap_year(d: ColumnOrName) -> Column:
    y = F.year(_c(d))
    return (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))


def hour12(ts: ColumnOrName) -> Column:
    h = F.hour(_c(ts))
    return F.when(h == 0, 12).when(h <= 12, h).otherwise(h - 12).cast("smallint")


def am_pm(ts: ColumnOrName) -> Column:
    return F.when(F.hour(_c(ts)) < 12, F.lit("AM")).otherwise(F.lit("PM"))


def time_24h(ts: ColumnOrName) -> Column:
    return F.date_format(_c(ts), "HH:mm")


def time_12h(ts: ColumnOrName) -> Column:
    """``12:05AM``, ``9:05AM``, ``12:05PM``, ``6:30PM`` — no leading zero on the hour."""
    ts = _c(ts)
    return F.concat(hour12(ts).cast("string"), F.lit(":"), F.date_format(ts, "mm"), am_pm(ts))


def part_of_day(ts: ColumnOrName) -> Column:
    h = F.hour(_c(ts))
    return (F.when(h.between(6, 11), "Morning")
            .when(h.between(12, 17), "Afternoon")
            .when(h.between(18, 23), "Evening")
            .otherwise("Night"))


def month_start(d: ColumnOrName) -> Column:
    return F.trunc(F.to_date(_c(d)), "month")


def month_end(d: ColumnOrName, cap=None) -> Column:
    """Last day of the month, optionally capped (``least`` skips NULL caps)."""
    e = F.last_day(F.to_date(_c(d)))
    return e if cap is None else F.least(e, as_date_lit(cap))


def next_month(d: ColumnOrName) -> Column:
    return F.add_months(month_start(d), 1)


def parse_local_ts(c: ColumnOrName) -> Column:
    """Wall-clock local time text, to the minute or the second → TIMESTAMP_NTZ (never shifted by
    the session zone); NULL if it is neither."""
    return F.coalesce(*(F.try_to_timestamp(_c(c), F.lit(f)).cast("timestamp_ntz")
                        for f in ("yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd'T'HH:mm:ss")))


def run_window(today, start=None, end=None) -> tuple[str, str]:
    """The run's (start, end) dates: both default to the day before ``today``."""
    t = _dt.date.fromisoformat(str(today)[:10])
    y = (t - _dt.timedelta(days=1)).isoformat()
    return (str(start)[:10] if start else y, str(end)[:10] if end else y)


def months_between(start, end) -> list[int]:
    """YYYYMM partition values touched by a date window (computed from the window, not data)."""
    s = _dt.date.fromisoformat(str(start)[:10])
    e = _dt.date.fromisoformat(str(end)[:10])
    out, y, m = [], s.year, s.month
    while (y, m) <= (e.year, e.month):
        out.append(y * 100 + m)
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def expected_hours(day: ColumnOrName, tz: ColumnOrName) -> Column:
    """Hours in a local calendar day of zone ``tz``: 24, or 23/25 on daylight-saving switch days."""
    d = F.to_date(_c(day))
    start = F.to_utc_timestamp(d.cast("timestamp"), _c(tz))
    end = F.to_utc_timestamp(F.date_add(d, 1).cast("timestamp"), _c(tz))
    return ((F.unix_timestamp(end) - F.unix_timestamp(start)) / 3600).cast("int")


def day_ids_between(start, end) -> list[int]:
    """YYYYMMDD keys of every day in a window (partition values of a day-partitioned table)."""
    s = _dt.date.fromisoformat(str(start)[:10])
    e = _dt.date.fromisoformat(str(end)[:10])
    return [int((s + _dt.timedelta(days=i)).strftime("%Y%m%d")) for i in range((e - s).days + 1)]
