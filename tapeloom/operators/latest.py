"""Latest-wins views and filtered reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _newest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def latest_bars(snapshots: DataFrame) -> DataFrame:
    """Newest capture of each bar by ingested_at; ties go to the greater run id."""
    return _newest(snapshots, ["code", "interval", "adjustment", "time_utc"], [F.desc_nulls_last("ingested_at"), F.desc_nulls_last("ingestion_run_id")])


def latest_contracts(df: DataFrame) -> DataFrame:
    return _newest(df, ["option_code"], [F.desc_nulls_last("captured_at"), F.desc_nulls_last("ingestion_run_id")])


def latest_volatility(df: DataFrame) -> DataFrame:
    return _newest(df, ["option_code", "trade_date", "source"], [F.desc_nulls_last("captured_at"), F.desc_nulls_last("ingestion_run_id")])


#: Days are counted from this many before 1970, so that every date has a number from 0; numbers have fewer bits than this.
_DAYS_BEFORE, _BITS = 1 << 20, 23


def _day(c: str) -> Column:
    return (F.unix_date(c) + _DAYS_BEFORE).cast("long")


def _dyadic(first: Column, last: Column) -> Column:
    """The fewest aligned spans of 2 ** level days that make up first..last, as (level, span); two of a level at most, none of a reversed or null range."""

    def at(level: Column) -> Column:
        size = F.pow(F.lit(2), level).cast("long")
        a, e = F.ceil(first / size), F.floor((last + 1) / size)
        left, right = F.when((a < e) & (a % 2 == 1), a), F.when((a < e) & (e % 2 == 1), e - 1)
        return F.transform(F.array_compact(F.array(left, right)), lambda n: F.struct(level.alias("level"), n.alias("span")))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(_BITS)), at))


def latest_calendar(rows: DataFrame) -> DataFrame:
    """For every date ever seen, the rows of the newest capture whose requested range covers it; a date that this capture lacks is withdrawn.

    Ranges are cut in aligned spans of days, each of which keeps its newest capture; a date then looks at the _BITS + 1 spans
    that hold it. So the work grows with the dates plus the captures, times a logarithm, and no task sees a whole scope.
    """
    scope = ["scope_type", "scope_value", "source"]
    rows = rows.withColumns({"_a": F.coalesce("requested_start_date", "trade_date"), "_b": F.coalesce("requested_end_date", "trade_date")})
    capture = F.struct("captured_at", "ingestion_run_id")  # nulls are the least
    captures = rows.select(*scope, "ingestion_run_id", "captured_at", "_a", "_b").distinct()
    spans = captures.select(*scope, capture.alias("capture"), F.explode(_dyadic(_day("_a"), _day("_b"))).alias("s")).groupBy(*scope, "s.level", "s.span").agg(F.max("capture").alias("capture"))
    level = F.explode(F.sequence(F.lit(0), F.lit(_BITS)))
    dates = rows.select(*scope, "trade_date").distinct().select(*scope, "trade_date", level.alias("level"))
    dates = dates.withColumn("span", F.floor(_day("trade_date") / F.pow(F.lit(2), F.col("level"))))
    chosen = dates.join(spans, [*scope, "level", "span"]).groupBy(*scope, "trade_date").agg(F.max("capture").alias("capture"))
    chosen = chosen.select(*scope, "trade_date", "capture.ingestion_run_id", F.col("capture.captured_at").alias("_captured"))
    out = rows.join(chosen, [*scope, "trade_date", "ingestion_run_id"]).filter(F.col("captured_at").eqNullSafe(F.col("_captured")))
    return out.drop("_a", "_b", "_captured")


def load_bars(latest: DataFrame, *, code=None, interval=None, adjustment=None, start=None, end=None, trade_date=None, session=None) -> DataFrame:
    """Filtered latest bars in the order of time_utc; start and end (of time_market) are included. The filters on date and session stand above the view, as an older capture must not come back.

    start and end also hold for time_utc, which is the same instant and a key of the view, so Spark pushes them to the scan; a
    bar without time_market is outside of every range.
    """
    df = latest
    for column, value in (("code", code), ("interval", interval), ("adjustment", adjustment), ("requested_trade_date", trade_date), ("session", session)):
        if value is not None:
            df = df.filter(F.col(column) == value)
    if start is not None:
        df = df.filter((F.col("time_market") >= F.lit(start)) & (F.col("time_utc") >= F.lit(start).cast("timestamp")))
    if end is not None:
        df = df.filter((F.col("time_market") <= F.lit(end)) & (F.col("time_utc") <= F.lit(end).cast("timestamp")))
    return df.orderBy("time_utc", "code", "interval", "adjustment")


def head(df: DataFrame, n: int) -> DataFrame:
    """The first n rows of an ordered result."""
    return df.limit(n)


def _scoped(df: DataFrame, scope_type: str, scope_value: str) -> DataFrame:
    return df.filter((F.col("scope_type") == scope_type) & (F.col("scope_value") == scope_value))


def load_calendar(latest: DataFrame, *, market: str | None = None, code: str | None = None, start=None, end=None) -> DataFrame:
    """Calendar rows of exactly one scope inside start..end, by date."""
    if bool(market) == bool(code):
        raise ValueError("give either a market or a code")
    df = _scoped(latest, "MARKET" if market else "CODE", (market or code).strip().upper())
    if start is not None:
        df = df.filter(F.col("trade_date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col("trade_date") <= F.lit(end).cast("date"))
    return df.orderBy("trade_date")


def calendar_dates(latest: DataFrame, scope_type: str, scope_value: str, start, end) -> DataFrame:
    days = F.col("trade_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return _scoped(latest, scope_type, scope_value).filter(days).select("trade_date").distinct()


def requested_ranges(rows: DataFrame, scope_type: str, scope_value: str, start, end) -> DataFrame:
    """Distinct requested ranges that overlap start..end."""
    overlap = (F.col("requested_start_date") <= F.lit(end).cast("date")) & (F.col("requested_end_date") >= F.lit(start).cast("date"))
    return _scoped(rows, scope_type, scope_value).filter(overlap).select(F.col("requested_start_date").alias("start"), F.col("requested_end_date").alias("end")).distinct()


def dates_after(latest: DataFrame, scope_type: str, scope_value: str, day) -> DataFrame:
    return _scoped(latest, scope_type, scope_value).filter(F.col("trade_date") > F.lit(day).cast("date")).select("trade_date").distinct()


def next_dates(after: DataFrame, dates: DataFrame, end) -> DataFrame:
    """code and next_date: for each (code, day) of after, the first of dates after day and at or before end; null if none."""
    days = dates.select("trade_date", F.lit(False).alias("asks")).distinct().filter(F.col("trade_date") <= F.lit(end).cast("date"))
    line = days.unionByName(after.select(F.col("day").alias("trade_date"), F.lit(True).alias("asks")).distinct())
    # One row for each calendar day and kind: a bounded line, walked from its end; an asking day comes before the same trading day.
    later = Window.orderBy(F.desc("trade_date"), F.desc("asks")).rowsBetween(Window.unboundedPreceding, -1)
    found = line.withColumn("next_date", F.min(F.when(~F.col("asks"), F.col("trade_date"))).over(later)).filter("asks").select(F.col("trade_date").alias("day"), "next_date")
    return after.join(found, "day", "left").select("code", "next_date")
