"""Local time, calendar steps and time differences over naive UTC timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from .fixed_values import LOCAL_ZONE


def local_ts(c, zone: str = LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(c, zone)


def local_date(c, zone: str = LOCAL_ZONE) -> Column:
    return F.to_date(local_ts(c, zone))


def local_hour(c, zone: str = LOCAL_ZONE) -> Column:
    return F.hour(local_ts(c, zone))


def weekday_name(c) -> Column:
    """English weekday without padding."""
    return F.date_format(c, "EEEE")


def day_of_week(c) -> Column:
    """0 = Sunday … 6 = Saturday."""
    return F.dayofweek(c) - 1


def iso_week(c) -> Column:
    return F.weekofyear(c)


def iso_year_week(c) -> Column:
    """Monday of the ISO week: unlike the bare week number it keeps the years apart."""
    return week_start(c)


def week_start(c) -> Column:
    return F.to_date(F.date_trunc("week", c))


def month_start(c) -> Column:
    return F.to_date(F.date_trunc("month", c))


def seconds_between(a, b) -> Column:
    """Second boundaries crossed from `a` to `b`."""
    return F.unix_seconds(F.col(b) if isinstance(b, str) else b) - F.unix_seconds(
        F.col(a) if isinstance(a, str) else a
    )


def minutes_between(a, b, elapsed: bool = False) -> Column:
    """Minute boundaries crossed from `a` to `b`, or whole minutes elapsed."""
    if elapsed:
        return F.floor(seconds_between(a, b) / 60).cast("long")
    ends = [F.unix_seconds(F.date_trunc("minute", x)) for x in (a, b)]
    return ((ends[1] - ends[0]) / 60).cast("long")


def days_between(a, b) -> Column:
    return F.datediff(b, a)


def minutes_elapsed(a, b) -> Column:
    """Fractional minutes from `a` to `b`."""
    return (F.unix_micros(b) - F.unix_micros(a)) / F.lit(6e7)


def parse_ticket_time(c) -> Column:
    """Text such as `01/31/2024 17:05`; text in another form gives NULL."""
    return F.try_to_timestamp(c, F.lit("MM/dd/yyyy HH:mm"))


def day_start_utc(day: dt.date, zone: str = LOCAL_ZONE) -> Column:
    """The UTC instant at which a local day begins; Catalyst folds it to a literal."""
    return F.to_utc_timestamp(F.lit(day.isoformat()).cast("timestamp"), zone)


def monday(day: dt.date) -> dt.date:
    return day - dt.timedelta(days=day.weekday())


def days(n: int) -> dt.timedelta:
    return dt.timedelta(days=n)


def week_bounds(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """`(start, end)` of the recent period that ends with the last closed week: [Monday-31d, Monday)."""
    end = monday(as_of)
    return end - days(31), end


def filter_local_day(
    df: DataFrame, ts: str, start: dt.date | None, end: dt.date | None, zone: str = LOCAL_ZONE,
    utc_day: str | None = None,
) -> DataFrame:
    """Keep local days in [start, end). The bounds meet the bare column, so they reach the scan.

    `utc_day` names the partition column of a table that is laid out by UTC day; it is bounded
    too, so that only the partitions of the period are read.
    """
    if start is not None:
        first = day_start_utc(start, zone)
        df = df.filter(F.col(ts) >= first)
        if utc_day:
            df = df.filter(F.col(utc_day) >= F.to_date(first))
    if end is not None:
        last = day_start_utc(end, zone)
        df = df.filter(F.col(ts) < last)
        if utc_day:
            df = df.filter(F.col(utc_day) <= F.to_date(last))
    return df


def filter_last_days(df: DataFrame, ts: str, n: int, as_of: dt.date, zone: str = LOCAL_ZONE) -> DataFrame:
    """The `n` local days before `as_of`, without `as_of` itself."""
    return filter_local_day(df, ts, as_of - days(n), as_of, zone)


def filter_mtd(df: DataFrame, ts: str, as_of: dt.date, zone: str = LOCAL_ZONE) -> DataFrame:
    """[first of the month, as_of)."""
    return filter_local_day(df, ts, as_of.replace(day=1), as_of, zone)


def filter_closed_weeks(df: DataFrame, ts: str, as_of: dt.date, zone: str = LOCAL_ZONE) -> DataFrame:
    """Everything before the Monday of the running week."""
    return filter_local_day(df, ts, None, monday(as_of), zone)


def filter_prev_week(df: DataFrame, ts: str, as_of: dt.date, zone: str = LOCAL_ZONE) -> DataFrame:
    """[Monday - 7 days, Monday)."""
    end = monday(as_of)
    return filter_local_day(df, ts, end - days(7), end, zone)


def filter_day_column(df: DataFrame, day: str, start: dt.date, end: dt.date) -> DataFrame:
    """[start, end) on a column that already holds a local date or local time."""
    return df.filter((F.col(day) >= F.lit(start)) & (F.col(day) < F.lit(end)))
