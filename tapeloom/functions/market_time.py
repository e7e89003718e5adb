"""Market clocks as column expressions. Instants are timestamps in a UTC session; local times are wall clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MARKET_ZONE = "America/New_York"
#: Seconds of the supported bar intervals.
INTERVAL_SECONDS = {"1m": 60, "5m": 300, "15m": 900, "30m": 1800, "60m": 3600}


def local_time_fault(local: Column, zone: str = MARKET_ZONE) -> Column:
    """'nonexistent' or 'ambiguous' for a local time that a clock change skips or repeats; else null. For zones that move by one hour."""
    instant = F.to_utc_timestamp(local, zone)
    hour = F.expr("interval 1 hour")
    missing = F.from_utc_timestamp(instant, zone) != local
    twice = (F.from_utc_timestamp(instant + hour, zone) == local) | (F.from_utc_timestamp(instant - hour, zone) == local)
    return F.when(missing, F.lit("nonexistent")).when(twice, F.lit("ambiguous"))


def to_instant(local: Column, zone: str = MARKET_ZONE, on_bad: str = "error") -> Column:
    """Local time to instant; a skipped, repeated or unreadable time is an error or, with on_bad='null', null. Null stays null."""
    parsed = F.try_to_timestamp(local.cast("string"))
    fault = F.when(local.isNotNull() & parsed.isNull(), F.lit("unreadable")).otherwise(local_time_fault(parsed, zone))
    instant = F.to_utc_timestamp(parsed, zone)
    if on_bad == "null":
        return F.when(fault.isNull(), instant)
    return F.when(fault.isNotNull(), F.raise_error(F.concat(fault, F.lit(" market time: "), local.cast("string"))).cast("timestamp")).otherwise(instant)


def market_local(instant: Column, zone: str = MARKET_ZONE) -> Column:
    """Wall clock of an instant."""
    return F.from_utc_timestamp(instant, zone)


def market_date(instant: Column, zone: str = MARKET_ZONE) -> Column:
    return F.to_date(market_local(instant, zone))


def session_label(instant: Column, zone: str = MARKET_ZONE) -> Column:
    """OVERNIGHT 20:00-04:00, PRE_MARKET 04:00-09:30, REGULAR 09:30-16:00, AFTER_HOURS 16:00-20:00, by the market's clock, ends excluded; null: UNKNOWN."""
    local = market_local(instant, zone)
    minute = F.hour(local) * 60 + F.minute(local)
    return (
        F.when(instant.isNull(), "UNKNOWN")
        .when((minute >= 240) & (minute < 570), "PRE_MARKET")
        .when((minute >= 570) & (minute < 960), "REGULAR")
        .when((minute >= 960) & (minute < 1200), "AFTER_HOURS")
        .otherwise("OVERNIGHT")
    )


def occurrence_date(instant: Column, session: Column, zone: str = MARKET_ZONE) -> Column:
    """The date a session belongs to: the small hours of an overnight session belong to the day before."""
    local = market_local(instant, zone)
    early = (session == "OVERNIGHT") & (F.hour(local) < 4)
    return F.when(early, F.date_sub(F.to_date(local), 1)).otherwise(F.to_date(local))


def interval_seconds(interval: Column) -> Column:
    """Seconds of an interval name in any case; an unsupported one is an error."""
    known = F.create_map(*(F.lit(x) for pair in INTERVAL_SECONDS.items() for x in pair))
    name = F.lower(F.trim(interval))
    return F.coalesce(known[name], F.raise_error(F.concat(F.lit("unsupported interval: "), F.coalesce(interval, F.lit("null")))).cast("int"))


def available_at(event_time: Column, seconds: Column) -> Column:
    """The first moment at which a bar that starts at event_time is complete."""
    return event_time + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def next_local_midnight(day: Column, zone: str) -> Column:
    """The instant at which the local day after `day` begins."""
    return F.to_utc_timestamp(F.date_add(day, 1).cast("timestamp"), zone)


def next_weekday(day: Column) -> Column:
    """day, or the Monday after it on a weekend."""
    return F.when(F.weekday(day) == 5, F.date_add(day, 2)).when(F.weekday(day) == 6, F.date_add(day, 1)).otherwise(day)


def previous_weekday(day: Column) -> Column:
    """day, or the Friday before it on a weekend."""
    return F.when(F.weekday(day) == 5, F.date_sub(day, 1)).when(F.weekday(day) == 6, F.date_sub(day, 2)).otherwise(day)


def date_chunks(start: Column, end: Column, days: int = 30) -> Column:
    """Array of (start, end): consecutive chunks of at most `days` days that fill start..end; empty when start is after end."""
    starts = F.sequence(start, end, F.expr(f"interval {days} days"))
    chunks = F.transform(starts, lambda s: F.struct(s.alias("start"), F.least(F.date_add(s, days - 1), end).alias("end")))
    return F.when(start <= end, chunks).otherwise(F.array().cast("array<struct<start:date,end:date>>"))


def volatility_period(start: Column, as_of: Column) -> Column:
    """The least look-back bucket that reaches from as_of to start; a start after as_of or over a year back is an error."""
    days = F.datediff(as_of, start)
    return (
        F.when((days < 0) | (days > 366), F.raise_error(F.lit("no look-back period covers the range")).cast("string"))
        .when(days <= 7, "WEEK")
        .when(days <= 31, "MONTH")
        .when(days <= 92, "QUARTER")
        .when(days <= 183, "HALF_YEAR")
        .when(days <= 366, "YEAR")
    )
