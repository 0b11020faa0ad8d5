"""Column expressions with the missing-value rules of the domain."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def known(value: Column) -> Column:
    """NaN as null."""
    return F.when(~F.isnan(value), value)


def flag(condition: Column) -> Column:
    """1.0 where `condition` holds, 0.0 where it doesn't or is unknown."""
    return F.when(F.coalesce(condition, F.lit(False)), 1.0).otherwise(0.0)


def total(value: Column) -> Column:
    """Sum of the known values; 0 where there are none."""
    return F.coalesce(F.sum(value), F.lit(0.0))


def strict_total(value: Column) -> Column:
    """Sum, null as soon as one value is missing."""
    return F.when(F.count("*") == F.count(value), F.sum(value))


def quantile(ordered: Column, p: Column) -> Column:
    """Linear quantile of a sorted array, to the last bit as in array libraries; null for an empty array."""
    at = (F.size(ordered) - 1) * p
    low, part = F.floor(at), at - F.floor(at)
    a, b = F.get(ordered, low.cast("int")), F.get(ordered, F.least(low + 1, F.size(ordered) - 1).cast("int"))
    return F.when(F.size(ordered) > 0, F.when(part >= 0.5, b - (b - a) * (1 - part)).otherwise(a + (b - a) * part))


def month_day(day: Column) -> Column:
    return F.month(day) * 100 + F.dayofmonth(day)


def in_season(day: Column, start: Column, end: Column) -> Column:
    """Whether the month and day of `day` lie between those of start and end, over the turn of the year where start is later."""
    md = month_day(day)
    return F.when(start <= end, (md >= start) & (md <= end)).otherwise((md >= start) | (md <= end))


def level_bin(value: Column, levels: tuple[float, ...]) -> Column:
    """How many levels are at most `value`; null for null."""
    return F.when(value.isNotNull(), sum((F.when(value >= x, 1).otherwise(0) for x in levels[1:]), F.when(value >= levels[0], 1).otherwise(0)))


def decode_months(months: Column, epoch: Column) -> Column:
    """The date `months` (rounded half to even) after `epoch`."""
    return F.add_months(epoch, F.bround(months).cast("int"))


def naive_micros(time: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 by the fields of a time without zone, whatever the zone of the session."""
    day = F.datediff(time, F.lit("1970-01-01")).cast("long")
    return (day * 24 + F.hour(time)) * 3_600_000_000 + F.minute(time).cast("long") * 60_000_000 + (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("long")


def naive_hours(time: Column) -> Column:
    """Whole hours since 1970-01-01 00:00 by the fields of a time without zone."""
    return F.datediff(time, F.lit("1970-01-01")).cast("long") * 24 + F.hour(time)


def hour_text(hours: Column) -> Column:
    """`yyyy-MM-dd HH:mm` of hours since 1970-01-01 00:00."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(hours / 24).cast("int"))
    return F.concat(day.cast("string"), F.lit(" "), F.lpad(F.pmod(hours, F.lit(24)).cast("string"), 2, "0"), F.lit(":00"))
