"""Instants, days and ages. Nothing here reads the wall clock: `as_of` is always given."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(as_of: datetime | str | Column) -> Column:
    """`as_of` as a timestamp column. Naive datetimes and texts are taken as UTC."""
    if isinstance(as_of, Column):
        return as_of
    moment = datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return F.lit(moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc))


def utc_day(as_of: datetime | str) -> date:
    """The UTC calendar day `as_of` falls on, for partition filters that must be literals."""
    moment = datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return (moment.astimezone(timezone.utc) if moment.tzinfo else moment).date()


def age_hours(as_of: datetime | str | Column, start: Column) -> Column:
    """Hours from `start` to `as_of`, to the microsecond."""
    return (F.unix_micros(instant(as_of)) - F.unix_micros(start)) / F.lit(3.6e9)


def _utc_text(moment: Column) -> Column:
    """`moment` in UTC, `yyyy-MM-dd HH:mm:ss[.f]`, counted from the epoch: the session's zone has no say."""
    seconds = (F.unix_micros(moment).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return (F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)).cast("string")


def partition_day(moment: Column) -> Column:
    """`dt`, the UTC day, of a record written at `moment`."""
    return F.substring(_utc_text(moment), 1, 10)


def iso_text(moment: Column) -> Column:
    """ISO-8601 text with offset, as the control log keeps time; no fraction when it is zero."""
    whole = F.replace(F.substring(_utc_text(moment), 1, 19), F.lit(" "), F.lit("T"))
    micros = F.pmod(F.unix_micros(moment), F.lit(1_000_000))
    fraction = F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise("")
    return F.concat(whole, fraction, F.lit("+00:00"))


def previous_business_day(day: Column) -> Column:
    """The day before `day`, stepping over Saturday and Sunday."""
    step = F.when(F.weekday(day) == 0, 3).when(F.weekday(day) == 6, 2).otherwise(1)
    return F.date_sub(day, step)
